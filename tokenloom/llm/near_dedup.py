"""MinHash near-dedup with circulant signatures.

One permutation scatters shingle hashes over a ring of slots; a second one,
read at K consecutive circular shifts, gives all K signature coordinates.
Coordinates are banded; documents that share a band are compared on their
full shingle sets, and links join into components.

Equal sets fold into one representative first.  One pass over the texts keeps
each set's size, key and band codes; full sets are made again only for the
representatives that are compared, and stage tables go when they have been read.

A band is never expanded into all pairs.  In each star round a document is
compared with the leaders that it shares most bands with (one in the first
round, then a few), and links join components.  Documents whose bands still join different components after
that meet on the rare shingles of their sets: shingles in order of rarity, two
sets of the wanted similarity share one of the first n - ceil(t * n) + 1 of
each, and sizes and positions must allow the overlap.  This step is exact.

Null or blank text has an empty set and no links.  A document is a doc_id and
a text: a component keeps one, also where ids are null or one id has several
texts.  The kept one has the component's smallest id that is not null, which
is the component_id (null if none has an id).  Rows that repeat doc_id and text
are one document, and each gets the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.llm.common import WordHash, id_text, map_rows, mix64, text_hashes, window_hashes, words
from tokenloom.session import cut_lineage, drop_stage

RING = 1 << 20
NO_ID = -(1 << 62)  # nodes of classes without a doc_id of their own are below this
MEMBERS_OF_A_SLICE = 1000  # members that meet one copy of a leader's set
BROADCAST_ROWS = 2_000_000  # rows of four longs; more are joined by shuffle
_RINGS: dict = {}


def shingle_set(text: str, size: int, memo: WordHash) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` lower-cased words; of
    the whole sequence if it is shorter."""
    h = memo.of(words(text, lower=True))
    return np.unique(window_hashes(h, min(size, len(h)) or 1) + np.uint64(min(size, len(h))))


def set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def signature(s: np.ndarray, coords: int, seed: int = 1) -> np.ndarray:
    """Circulant MinHash: coordinate j is the least second permutation,
    shifted by j, over the scattered slots of the set."""
    if (coords, seed) not in _RINGS:
        rng = np.random.default_rng(seed)
        scatter, values = rng.permutation(RING).astype(np.int32), rng.permutation(RING).astype(np.int32)
        _RINGS[coords, seed] = scatter, np.lib.stride_tricks.sliding_window_view(np.concatenate((values, values[: coords - 1])), coords)
    scatter, shifted = _RINGS[coords, seed]
    slots = scatter[(s & np.uint64(RING - 1)).astype(np.int64)]
    best = np.full(coords, RING, np.int32)
    for at in range(0, len(slots), 1024):
        best = np.minimum(best, shifted[slots[at : at + 1024]].min(axis=0))
    return best


def band_codes(s: np.ndarray, bands: int, rows: int) -> np.ndarray:
    sig = signature(s, bands * rows).astype(np.uint64).reshape(bands, rows)
    code = np.arange(bands, dtype=np.uint64)
    for j in range(rows):
        code = mix64(code * np.uint64(0x9E3779B97F4A7C15) + sig[:, j] + np.uint64(1))
    return code.view(np.int64)


def _members(size: int, bands: int, rows: int):
    """doc_id, h1, h2, n_shingles, key and codes of each text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHash()
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part, out = pdf.iloc[at : at + 500], []
                for doc_id, text, h1, h2 in zip(part["doc_id"], part["text"], part["h1"], part["h2"]):
                    s = shingle_set(text, size, memo)
                    some = len(s) > 0
                    out.append((doc_id, h1, h2, len(s), set_key(s) if some else None, band_codes(s, bands, rows) if some else None))
                yield pd.DataFrame(out, columns=["doc_id", "h1", "h2", "n_shingles", "key", "codes"])

    return run


def _node_sets(size: int):
    """node, shingles of each text; repeated rows of a batch once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = WordHash()
        for pdf in batches:
            pdf = pdf.drop_duplicates("node")
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                yield pd.DataFrame({"node": part["node"], "shingles": [shingle_set(t, size, memo).view(np.int64) for t in part["text"]]})

    return run


def node_sets(base: DataFrame, classes: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """node, shingles for some representatives, made from their texts."""
    lead = classes.join(nodes, "node").select("node", F.col("lead.doc_id").alias("r"), F.col("lead.h1").alias("r1"), F.col("lead.h2").alias("r2"))
    lead = cut_lineage(lead, "near-wanted")
    wanted = F.broadcast(lead) if lead.count() <= BROADCAST_ROWS else lead
    same = (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")) & F.col("doc_id").eqNullSafe(F.col("r"))
    made = base.join(wanted, same).select("node", "text").mapInPandas(_node_sets(size), "node long, shingles array<long>")
    sets = cut_lineage(made.groupBy("node").agg(F.first("shingles").alias("shingles")), "near-sets")
    drop_stage(lead)
    return sets


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have Jaccard of at least ``percent``.
    A node that is ``a`` of many pairs has its set repeated for slices of them."""
    often = pairs.groupBy("a").agg((F.count(F.lit(1)) / MEMBERS_OF_A_SLICE).cast("int").alias("more")).where("more > 0")
    dealt = pairs.join(often, "a", "left").withColumn("slice", F.coalesce(F.pmod(F.xxhash64("b"), F.col("more") + 1), F.lit(0)))
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")).join(often, "a", "left")
    one = one.select("a", "sa", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("more", F.lit(0)).cast("long"))).alias("slice"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        dealt.select("a", "b", F.col("slice").cast("long").alias("slice"))
        .join(two, "b")
        .join(one, ["a", "slice"])
        .select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb")).alias("s"))
        .where(100 * F.col("i").cast("long") >= percent * (F.col("s") - F.col("i")))
        .select("a", "b")
    )


def rare_pairs(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels that share one of each other's rarest
    shingles and whose sizes and positions allow the wanted overlap: a superset
    of all pairs with that similarity."""
    each = sets.select("node", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("s"))
    often = each.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("df", "s")).cast("long")  # one set
    need = F.expr(f"({percent} * n + 99) div 100")
    first = each.join(often, "s").withColumn("i", place).where((F.col("i") <= F.col("n") - need + 1) & (F.col("df") > 1))
    first = cut_lineage(first.join(labels, "node").select("node", "label", "n", "s", "i"), "near-rare")
    a = first.select(F.col("node").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), "s", F.col("i").alias("ia"))
    b = first.select(F.col("node").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"), "s", F.col("i").alias("ib"))
    overlap = F.expr(f"{100 + percent} * (1 + least(na - ia, nb - ib)) >= {percent} * (na + nb)")
    close = F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    found = a.join(b, "s").where((F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & close & overlap)
    pairs = cut_lineage(found.select("a", "b").distinct(), "near-pairs")
    drop_stage(first)
    return pairs


def join_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label) after joining the components that links connect;
    a label is the least node of its component."""
    while True:
        la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        edges = links.join(la, "a").join(lb, "b").where("la <> lb")
        up = cut_lineage(
            edges.select(F.greatest("la", "lb").alias("v"), F.least("la", "lb").alias("p")).groupBy("v").agg(F.min("p").alias("p")), "hooks"
        )
        if up.isEmpty():
            drop_stage(up)
            return labels
        while True:  # follow parents until all point to roots
            hop = up.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            nxt = cut_lineage(up.join(hop, "p", "left").select("v", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")), "jumps")
            done = nxt.where("moved").isEmpty()
            drop_stage(up)
            up = nxt.select("v", "p")
            if done:
                break
        joined = labels.join(up.select(F.col("v").alias("label"), "p"), "label", "left")
        old, labels = labels, cut_lineage(joined.select("node", F.coalesce("p", "label").alias("label")), "labels")
        drop_stage(old, up)


def near_dedup(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 36, rows: int = 5, star_rounds: int = 4, leaders: int = 6) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, h1, h2
    (128 bits of the text's hash), class_key.

    Links join sets with 100 * intersection >= percent * union.  With 36 bands
    of 5 a pair at 0.8 shares no band with probability 6e-7.
    """
    base = id_text(docs).select("doc_id", "text", *text_hashes("text"))
    kinds = "doc_id long, h1 long, h2 long, n_shingles long, key binary, codes array<long>"
    members = cut_lineage(map_rows(base, _members(shingle, bands, rows), kinds), "near-members")
    # A class of equal sets goes by its smallest doc_id; one without any, or
    # whose smallest is that of other classes too, by a hash below NO_ID.
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h1", "h2")).alias("lead")
    full = members.where("key is not null").groupBy("key")
    found = cut_lineage(full.agg(lead, F.first("n_shingles").alias("n"), F.first("codes").alias("codes")), "near-found")
    several = found.where("lead.doc_id is not null").groupBy(F.col("lead.doc_id").alias("least")).count().where("count > 1").select("least")
    own = found.join(several, F.col("lead.doc_id") == F.col("least"), "left").withColumn("own", F.when(F.col("least").isNull(), F.col("lead.doc_id")))
    node = F.coalesce("own", NO_ID - F.shiftrightunsigned(F.xxhash64("key"), 2)).alias("node")
    classes = cut_lineage(own.select("key", "lead", "n", node), "near-classes")
    banded = found.join(classes.select("key", "node"), "key").select("node", "n", F.explode("codes").alias("band"))
    shared = cut_lineage(banded.groupBy("band").count().where("count > 1").select("band"), "near-shared")
    live = cut_lineage(banded.join(shared, "band"), "near-live")
    drop_stage(shared, found)
    labels = cut_lineage(live.select("node").distinct().select("node", F.col("node").alias("label")), "labels")

    close = f"100 * least(n, l.n) >= {percent} * greatest(n, l.n)"
    for step in range(star_rounds + 1):
        if step:  # bands that join different components
            split = live.join(labels, "node").groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y"))
            split = cut_lineage(split.where("x <> y").select("band"), "near-open")
            old, live = live, cut_lineage(live.join(split, "band"), "near-live")
            drop_stage(old, split)
            if live.isEmpty():
                break
        if step < star_rounds:
            now = live.join(labels, "node")
            # The first round has one hub for all bands of a group; later ones a leader for each band.
            draw = F.xxhash64("node", "band", F.lit(step)) if step else F.xxhash64("node")
            lead = now.groupBy("band").agg(F.min(F.struct(draw.alias("h"), "node", "n", "label")).alias("l"))
            met = now.join(lead, "band").where(f"label <> l.label and {close}").groupBy(F.col("l.node").alias("a"), F.col("node").alias("b")).count()
            best = Window.partitionBy("b").orderBy(F.col("count").desc(), F.xxhash64("a", "b"))  # a document has at most as many leaders as bands
            some = met.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= (leaders if step else 1))
            pairs = cut_lineage(some.select("a", "b"), "near-pairs")
            sets = node_sets(base, classes, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), shingle)
        else:
            sets = node_sets(base, classes, live.select("node").distinct(), shingle)
            pairs = rare_pairs(sets, labels, percent)
        links = cut_lineage(linked(pairs, sets, percent), "near-links")
        drop_stage(sets, pairs)
        labels = join_components(labels, links)
        drop_stage(links)
    drop_stage(live)

    roots = labels.where("node <> label")
    root = F.coalesce("label", "node")
    whole = cut_lineage(classes.join(roots, "node", "left").select("key", "node", "lead", root.alias("root")), "near-roots")
    plain = whole.where(F.col("root") >= NO_ID).select("key", F.col("root").alias("component_id"), F.when(F.col("node") == F.col("root"), F.col("lead")).alias("lead"))
    hashed = whole.where(F.col("root") < NO_ID)  # the root's place says nothing about ids
    first = hashed.groupBy("root").agg(F.min("lead").alias("lead"))
    whole = plain.unionByName(hashed.select("key", "root").join(first, "root").select("key", F.col("lead.doc_id").alias("component_id"), "lead"))
    leads = F.col("doc_id").eqNullSafe(F.col("lead.doc_id")) & (F.col("h1") == F.col("lead.h1")) & (F.col("h2") == F.col("lead.h2"))
    return members.join(whole, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("key").isNull() | (F.col("lead").isNotNull() & leads)).alias("kept"),
        "h1",
        "h2",
        "key",
    ).withColumnRenamed("key", "class_key")
