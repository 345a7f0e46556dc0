"""SimHash near-duplicates with pivot distance tables.

Fingerprints: 64 bits over three-word shingles.  Distinct fingerprints are linked when at most
``MOST_BITS`` bits differ.  Two such fingerprints agree on at least two of four 16-bit blocks, so
candidates meet in blocks keyed by a pair of blocks (six tables).  Inside a block every fingerprint
has its Hamming distances to ``PIVOTS`` reference fingerprints; a pair whose distance to any of them
differs by more than ``MOST_BITS`` cannot be linked (triangle inequality) and is discarded, and
the survivors are verified bit by bit.  A task joins what it links locally and sends one
edge per fingerprint, never all pairs.  Blocks over ``BLOCK`` members are split
into pieces and every pair of pieces becomes a bounded group of its own, so no link is lost.

Equal texts share a fingerprint, so copies are one candidate.  Null or wordless text has fingerprint
zero and is linked like any other.  A null doc_id takes part but never names a component: its
component_id is the smallest known id of the component, or null.  Repeated rows are returned as often
as they occur.  Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, materialize, parts, ship, table, text_digest

SHINGLE, SEED, MOST_BITS = 3, 42, 2
PIVOTS = 24
BLOCK = 2_048
#: The pairs of 16-bit blocks on which two linked fingerprints may agree.
MASKS = [sum(0xFFFF << 16 * b for b in pair) for pair in combinations(range(4), 4 - MOST_BITS)]


def fingerprint(text: str) -> int:
    """Fingerprint of a whole text (unsigned)."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()   # bytes: only A-Z change, ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends)]
    total, n = np.zeros(64, np.int64), max(1, len(words) - SHINGLE + 1)
    last = ends[SHINGLE - 1:] or [len(joined)]
    for lo in range(0, n, 65_536):
        h = np.array([xxh64_intdigest(joined[a:b], SEED)
                      for a, b in zip(starts[lo: lo + 65_536], last[lo: lo + 65_536])], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * total > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text) and ``fp`` (signed 64 bits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text"):
            fps = np.array([fingerprint(t or "") for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["doc_id", "digest", "fp"])

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_digest().alias("digest"), "text").mapInArrow(
        run, f"doc_id {kind}, digest long, fp long")


def pivot_distances(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints to the references (one row each)."""
    pivots = np.random.default_rng(9).integers(0, 2**64, PIVOTS, dtype=np.uint64)
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def linked(group: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions, same group (groups are contiguous) and at most MOST_BITS apart."""
    table = pivot_distances(fps)
    left, right = [], []
    at, step = np.arange(len(fps)), 1
    while True:
        at = at[at + step < len(fps)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            break
        near = at
        for columns in (slice(0, 4), slice(4, PIVOTS)):   # few references settle most pairs
            near = near[np.abs(table[near, columns] - table[near + step, columns]).max(axis=1) <= MOST_BITS]
        near = near[np.bitwise_count(fps[near] ^ fps[near + step]) <= MOST_BITS]
        left.append(near)
        right.append(near + step)
        step += 1
    none = [np.empty(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _edges(group: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One edge per fingerprint that is linked here, to the smallest it reaches here."""
    left, right = linked(group, fps)
    values, where = np.unique(fps.view(np.int64), return_inverse=True)
    a, b = where[left], where[right]
    root = np.arange(len(values))
    while len(a):   # hook the larger root to the smaller, then jump
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(values)))
    return values[moved], values[root[moved]]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a group that a batch cuts is carried (its size is bounded)."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def flush(group: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(fps):
            a, b = _edges(np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]).any(axis=1)])), fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append((np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in ("t", "key", "p", "q")], axis=1),
                     batch.column("fp").to_numpy(zero_copy_only=False)))
        group, fps = (np.concatenate(x) for x in zip(*held))
        cut = int(np.flatnonzero((group != group[-1]).any(axis=1))[-1]) + 1 if (group != group[-1]).any() else 0
        yield from flush(group[:cut], fps[:cut])
        held = [(group[cut:], fps[cut:])]
    if held:
        yield from flush(*held[0])


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all of the distinct ``fp`` that are linked."""
    ship(distinct.sparkSession)
    masks = [m - (1 << 64) if m >> 63 else m for m in MASKS]
    keyed = distinct.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("t", "key"))
    sizes = keyed.groupBy("t", "key").count().where("count > 1")
    pieces = F.ceil(F.col("count") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), pieces).cast("int")
    rows = keyed.join(sizes, ["t", "key"]).select(
        "t", "key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), pieces - 1)).alias("other"))
    rows = rows.select("t", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp")
    return (rows.repartition("t", "key", "p", "q").sortWithinPartitions("t", "key", "p", "q", "fp")
            .mapInArrow(_stream, "a long, b long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, digest, fp, component_id (and ``root``, the component's fingerprint)."""
    prints = materialize(fingerprints(docs))
    firsts = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    joined = components(links(firsts.select("fp")))
    rooted = firsts.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(lowest, "root")
    return prints.join(named, "fp").select("doc_id", "digest", "fp", "component_id", "root")


def op9(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document of smallest id stays (ties: one of the equal
    rows; if no id is known, the row of smallest text digest)."""
    keys = [F.col("doc_id").isNull().alias("__null"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__id")]
    found = near_duplicates(docs).select("root", *keys, F.col("digest").alias("__digest"))
    kept = found.groupBy("root").agg(F.min(F.struct("__null", "__id", "__digest")).alias("k")).select("k.*")
    order = Window.partitionBy("__null", "__id", "__digest").orderBy(F.lit(1))
    return (docs.select("*", *keys, text_digest().alias("__digest")).join(kept, ["__null", "__id", "__digest"], "left_semi")
            .withColumn("__row", F.row_number().over(order)).where("__row = 1").select(*docs.columns))
