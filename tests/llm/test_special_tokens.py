"""Texts that hold special tokens, against the plain tokenizers call."""

import zlib

import numpy as np
import public_tokenizers as P

from tokenloom.llm import queries

TEXTS = ["a river <|endoftext|> stone", "<|startoftext|>light<|endoftext|>", "plain", None]


def test_op4_packing_encodes_special_tokens_like_the_default(spark, tmp_path):
    from tokenizers import Tokenizer

    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in queries.op4_packing(spark, str(tmp_path)).collect()}
    for i, t in enumerate(TEXTS):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        assert (got[i].doc_tokens, got[i].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert got[0].doc_tokens == 5
