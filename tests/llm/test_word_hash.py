"""Tasks remember few word hashes, whatever the words."""

import xxhash

from tokenloom.llm.common import WordHash


def test_a_task_remembers_few_hashes():
    """It remembered 2^19 words, about 100 MB of each worker, in near and substring dedup."""
    memo = WordHash()
    ws = [str(i).encode() for i in range(70_000)] + [b"1", b"69999"]
    assert memo.of(ws).tolist() == [xxhash.xxh64_intdigest(w) for w in ws]
    assert len(memo) <= 1 << 16
