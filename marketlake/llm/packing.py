"""Best-fit packing of documents into training sequences by a grouping genetic algorithm.

A document is its ids followed by ``END``; only documents longer than a sequence are cut, into full
pieces after a first one that may be shorter.  Full pieces are sequences already.  The others are
dealt into shards of about ``SHARD`` pieces; each shard is worked on by several islands, each
with a small population of packings:

* a packing starts as best-fit decreasing over slightly disturbed lengths;
* crossover injects whole well-filled bins of one parent into another, removes the bins
  that hold any of the injected pieces, and puts displaced pieces back by best fit;
* mutation dissolves some badly filled bins the same way;
* after every round the islands of a shard pass their best packing on round the ring.

Fitness is the mean of (fill / capacity) squared; an island that reaches the least number of bins that its
tokens allow rests.  Sequences that stay below ``FULL`` give their pieces to the next level, which deals them
anew by another key into fewer shards, until one shard is left, the least number is reached, or ``STALLS``
levels in a row finish less than a share ``HELPS`` of their pieces (sizes that do not fill a sequence).  Every
level but the last two of a stall shrinks its input by that share, so all levels together cost a constant
number of first ones.  Every task holds
one island (bounded), all draws are seeded by shard, island and round, so a lost task is repeated exactly.

Null text is an empty document (just ``END``).  Repeated rows are packed as often as they occur; null
ids are packed like others.  Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import load
from .common import materialize, parts, ship, table

CAPACITY, END = 1024, 2
SHARD, ISLANDS, POPULATION, ROUNDS, CHILDREN = 4_096, 4, 4, 4, 24
#: A sequence is done when it is this full; a level helps when it finishes this share of its pieces; levels in a
#: row that do not help end the search.
FULL, HELPS, STALLS = 0.97, 0.1, 2


def pieces(docs: DataFrame, with_ids: bool = False, path: str | None = None) -> DataFrame:
    """uid, doc_id, piece, start, length, ids_crc32 (and ``ids``, little-endian 32-bit) of each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = load(path), np.array([END], "<u4")
        for batch in parts(batches, "text"):
            rows, piece, start, length, crc, data = [], [], [], [], [], []
            for row, ids in enumerate(bpe.encode([t or "" for t in batch.column(1).to_pylist()])):
                ids = np.concatenate([ids.astype("<u4"), end])
                first = (len(ids) - 1) % CAPACITY + 1
                for k, lo in enumerate([0, *range(first, len(ids), CAPACITY)]):
                    part = ids[lo: first if k == 0 else lo + CAPACITY].tobytes()
                    rows.append(row)
                    piece.append(k)
                    start.append(lo)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        data.append(part)
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(data, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else ""))
    # numbered as they are written; the written rows keep their numbers
    return materialize(cut.select(F.monotonically_increasing_id().alias("uid"), "*"))


class BestFit:
    """Bins by free space: the tightest bin that takes a piece is one bit scan away."""

    def __init__(self, free: np.ndarray):
        self.free = free.tolist()
        self.at: list[list[int]] = [[] for _ in range(CAPACITY + 1)]
        self.mask = 0
        for b, f in enumerate(self.free):
            if f:
                self.at[f].append(b)
                self.mask |= 1 << f

    def put(self, size: int) -> int:
        above = self.mask >> size
        if above:
            space = size + (above & -above).bit_length() - 1
            b = self.at[space].pop()
            if not self.at[space]:
                self.mask ^= 1 << space
        else:
            b, space = len(self.free), CAPACITY
            self.free.append(CAPACITY)
        left = space - size
        self.free[b] = left
        if left:
            self.at[left].append(b)
            self.mask |= 1 << left
        return b


def refill(sizes: np.ndarray, bins: np.ndarray, loose: np.ndarray) -> np.ndarray:
    """Put loose pieces (bins = -1) back by best fit, largest first; bins are renumbered."""
    placed = bins >= 0
    used, number = np.unique(bins[placed], return_inverse=True)
    out = np.full(len(bins), -1, np.int32)
    out[placed] = number
    fit = BestFit(CAPACITY - np.bincount(number, sizes[placed], len(used)).astype(np.int64))
    for i in loose.tolist():
        out[i] = fit.put(int(sizes[i]))
    return out


def fills(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, sizes)


def fitness(sizes: np.ndarray, bins: np.ndarray) -> float:
    return float(np.square(fills(sizes, bins) / CAPACITY).mean())


def crossover(sizes: np.ndarray, into: np.ndarray, donor: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Inject some well-filled bins of the donor."""
    full = fills(sizes, donor)
    good = np.flatnonzero(full >= np.median(full))
    chosen = good[rng.random(len(good)) < rng.uniform(0.1, 0.5)]
    injected = np.isin(donor, chosen)
    child = into.copy()
    child[np.isin(into, np.unique(into[injected]))] = -1       # bins that held an injected piece
    child[injected] = donor[injected] + into.max() + 1
    loose = np.flatnonzero(child < 0)
    return refill(sizes, child, loose[np.argsort(-sizes[loose], kind="stable")])


def mutate(sizes: np.ndarray, bins: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Dissolve some of the worst filled bins and a few others."""
    full = fills(sizes, bins)
    worst = np.argsort(full, kind="stable")[: max(2, len(full) // 50)]
    gone = np.isin(bins, np.concatenate([worst, rng.integers(0, len(full), max(1, len(full) // 20))]))
    child = np.where(gone, -1, bins).astype(np.int32)
    loose = np.flatnonzero(gone)
    disturbed = sizes[loose] * rng.uniform(0.8, 1.25, len(loose))
    return refill(sizes, child, loose[np.argsort(-disturbed, kind="stable")])


def evolve(sizes: np.ndarray, population: list[np.ndarray], rng: np.random.Generator) -> list[np.ndarray]:
    """One round on one island; the best comes first."""
    bound = -(-int(sizes.sum()) // CAPACITY)
    if not population:
        for k in range(POPULATION):
            order = np.argsort(-sizes * (rng.uniform(0.97, 1.03, len(sizes)) if k else 1.0), kind="stable")
            population.append(refill(sizes, np.full(len(sizes), -1, np.int32), order))
    scored = sorted(((fitness(sizes, p), k, p) for k, p in enumerate(population)), key=lambda x: (-x[0], x[1]))
    for k in range(CHILDREN):
        if int(scored[0][2].max()) + 1 <= bound:   # no packing can have fewer bins
            break
        a, b = sorted(rng.integers(0, len(scored), 2).tolist())
        child = crossover(sizes, scored[a][2], scored[b][2], rng) if a != b else scored[a][2]
        if a == b or rng.random() < 0.5:
            child = mutate(sizes, child, rng)
        scored.append((fitness(sizes, child), POPULATION + k, child))
        scored = sorted(scored, key=lambda x: (-x[0], x[1]))[:POPULATION]
    return [p for _, _, p in scored]


_STATE = "shard long, island int, uids binary, sizes binary, population array<binary>"


def _island(round_: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                sizes = np.frombuffer(r["sizes"], "<i4").astype(np.int64)
                rng = np.random.default_rng([r["shard"], r["island"], round_])
                grown = evolve(sizes, [np.frombuffer(p, "<i4") for p in r["population"]], rng)
                out.append([p.astype("<i4").tobytes() for p in grown])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(out, pa.list_(pa.binary()))], batch.schema.names)
    return run


def _gather(tbl: pa.Table) -> pa.Table:
    """The pieces of a shard -> one row per island."""
    uids, sizes = tbl.column("uid").to_numpy(), tbl.column("length").to_numpy()
    order = np.argsort(uids)
    row = [tbl.column("shard")[0].as_py(), uids[order].astype("<i8").tobytes(), sizes[order].astype("<i4").tobytes()]
    return pa.table({"shard": pa.array([row[0]] * ISLANDS, pa.int64()), "island": pa.array(range(ISLANDS), pa.int32()),
                     "uids": pa.array([row[1]] * ISLANDS, pa.binary()), "sizes": pa.array([row[2]] * ISLANDS, pa.binary()),
                     "population": pa.array([[]] * ISLANDS, pa.list_(pa.binary()))})


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best packing of a shard -> uid, length, bin, fill, offset."""
    for batch in batches:
        for r in batch.to_pylist():
            uids, sizes = np.frombuffer(r["uids"], "<i8"), np.frombuffer(r["sizes"], "<i4").astype(np.int64)
            packings = [np.frombuffer(p, "<i4") for p in r["bests"]]
            bins = max(packings, key=lambda p: fitness(sizes, p))
            order = np.argsort(bins, kind="stable")
            upto = np.cumsum(sizes[order]) - sizes[order]
            first = np.searchsorted(bins[order], bins[order])
            offset = upto - upto[first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(uids), r["shard"])), pa.array(uids[order]), pa.array(sizes[order]),
                 pa.array(bins[order].astype(np.int64)), pa.array(fills(sizes, bins)[bins[order]].astype(np.int64)),
                 pa.array(offset)], ["shard", "uid", "length", "bin", "fill", "offset"])


def _level(items: DataFrame, n: int, level: int) -> tuple[DataFrame, int]:
    """Pack (uid, length): shard, uid, length, bin, fill, offset; and the number of shards."""
    shards = -(-n // SHARD)
    tasks = -(-shards * ISLANDS // 4)
    state = (items.withColumn("shard", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards)))
             .groupBy("shard").applyInArrow(_gather, _STATE))
    for round_ in range(ROUNDS):
        # packing is long work on few bytes: the number of tasks is given, not left to partition sizes
        state = state.repartition(tasks, "shard", "island").mapInArrow(_island(level * ROUNDS + round_), _STATE)
        if round_ < ROUNDS - 1:
            state = materialize(state)
            elite = state.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"),
                                 F.col("population")[0].alias("elite"))
            state = state.join(elite, ["shard", "island"]).select(
                "shard", "island", "uids", "sizes",
                F.concat(F.array("elite"), F.slice("population", 1, POPULATION - 1)).alias("population"))
    best = state.groupBy("shard").agg(F.first("uids").alias("uids"), F.first("sizes").alias("sizes"),
                                      F.sort_array(F.collect_list(F.col("population")[0])).alias("bests"))
    return best.mapInArrow(_place, "shard long, uid long, length long, bin long, fill long, offset long"), shards


def place(items: DataFrame) -> DataFrame:
    """uid, sequence_id, offset of every piece (uid, length)."""
    full = items.where(F.col("length") == CAPACITY).select("uid", F.col("uid").alias("sequence_id"),
                                                          F.lit(0).cast("long").alias("offset"))
    rest, level, done = items.where(F.col("length") < CAPACITY).select("uid", "length"), 0, [full]
    n, stalls = rest.count(), 0
    while n:
        packed, shards = _level(rest, n, level)
        packed = materialize(packed)
        # numbers below zero, apart from the full pieces'; a sequence is named after its smallest piece
        name = packed.groupBy("shard", "bin").agg((-F.min("uid") - 1).alias("sequence_id"))
        packed = packed.join(name, ["shard", "bin"])
        loose = packed.where(F.col("fill") < FULL * CAPACITY)
        left = loose.count() if shards > 1 else 0
        if left:   # as few sequences as their bytes allow: nothing to gain
            held = packed.agg(F.countDistinct("shard", "bin").alias("bins"), F.sum("length").alias("tokens")).first()
            left = 0 if held["bins"] <= -(-held["tokens"] // CAPACITY) else left
        stalls = stalls + 1 if left > (1 - HELPS) * n else 0
        if left == 0 or stalls == STALLS:
            done.append(packed.select("uid", "sequence_id", "offset"))
            break
        done.append(packed.where(F.col("fill") >= FULL * CAPACITY).select("uid", "sequence_id", "offset"))
        rest, n, level = loose.select("uid", "length"), left, level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack(docs: DataFrame, with_ids: bool = False, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ``ids``) of every piece."""
    cut = pieces(docs, with_ids, path)
    placed = place(cut.select("uid", "length"))
    return cut.join(placed, "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                                          *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ``ids`` (array<binary>, in order) from a packing with ids; at most CAPACITY ids each."""
    return packed.groupBy("sequence_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]).alias("ids"))


def op10(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def pack_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packing of what is left."""
    return pack(docs)
