"""Line deduplication: lines found in many documents stay in the last of them only.

A line's key (blanks stripped, A-Z lowered) is told by 128 bits of BLAKE2b.  One aggregate counts, per key,
the documents that hold it and the largest doc_id.  Keys of at least two documents are dealt to shards by
hash; each shard gets a minimal perfect hash (levels of bit arrays; a key that collides in one level goes
on to the next; a slot is the rank of its bit) over three arrays: fingerprint, count, last document.
Documents then probe the arrays where they are: a slot whose fingerprint agrees gives the count and the
document that keeps the line.  No line is joined and no text is shuffled.

The arrays go to the workers in pieces of at most ``PIECE_BYTES``, whatever their total; one pass over the
documents per piece, with a written table between passes.

Null text is one empty line.  Rows that repeat a doc_id are one document when documents are counted, and
each keeps its own row; a null doc_id is a document before all others.  Repeats of a line inside a document
stay or go together.  An empty table gives no rows.  The result has only the columns named here, so others
cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, parts, ship, table, whole_text

MIN_CHARS, MIN_DOCS = 40, 5
#: Keys a shard holds on average, and bytes of arrays that are sent to the workers at a time.
SHARD_KEYS, PIECE_BYTES = 1 << 16, 64 << 20
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
NO_ID = -(1 << 63)

SHARD = "shard int, keys long, words binary, starts binary, prints binary, counts binary, last binary"
_SHARD = pa.schema([("shard", pa.int32()), ("keys", pa.int64())]
                   + [(n, pa.binary()) for n in ("words", "starts", "prints", "counts", "last")])


# ---- minimal perfect hash ------------------------------------------------------------------------

def _level_hash(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    x = a + b * np.uint64(0x9E3779B97F4A7C15) + np.uint64((level + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return x ^ (x >> np.uint64(31))


def build_levels(a: np.ndarray, b: np.ndarray, spare: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """Bit arrays of all levels (64-bit words, end to end) and where each level starts; keys are distinct."""
    levels, starts = [], [0]
    while len(a):
        size = -(-int(spare * len(a)) // 64)
        at = (_level_hash(a, b, len(levels)) % np.uint64(64 * size)).astype(np.int64)
        alone = np.bincount(at, minlength=64 * size) == 1
        levels.append(np.packbits(alone, bitorder="little").view("<u8"))
        starts.append(starts[-1] + size)
        rest = ~alone[at]
        a, b = a[rest], b[rest]
    return (np.concatenate(levels) if levels else np.zeros(0, np.uint64)), np.array(starts, np.int64)


class Levels:
    def __init__(self, words: np.ndarray, starts: np.ndarray):
        self.words, self.starts = words, starts
        self.upto = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of every key; another text's key gets any slot or -1."""
        out, live = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level in range(len(self.starts) - 1):
            if not len(live):
                break
            size = 64 * int(self.starts[level + 1] - self.starts[level])
            at = _level_hash(a[live], b[live], level) % np.uint64(size)
            word, bit = self.starts[level] + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            held = self.words[word]
            hit = (held >> bit) & np.uint64(1) != 0
            below = held[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[live[hit]] = self.upto[word[hit]] + np.bitwise_count(below)
            live = live[~hit]
        return out


def _build_shard(group: pa.Table) -> pa.Table:
    a, b, docs, last = (group.column(n).to_numpy() for n in ("a", "b", "docs", "last"))
    a, b = a.view(np.uint64), b.view(np.uint64)
    words, starts = build_levels(a, b)
    slots = Levels(words, starts).slots(a, b)
    prints, counts, lasts = np.empty_like(b), np.empty(len(a), np.uint32), np.empty_like(last)
    prints[slots], counts[slots], lasts[slots] = b, np.minimum(docs, 0xFFFFFFFF), last
    arrays = [x.tobytes() for x in (words, starts, prints, counts, lasts)]
    return pa.Table.from_pydict({"shard": [group.column("shard")[0].as_py()], "keys": [len(a)],
                                 **dict(zip(_SHARD.names[2:], ([x] for x in arrays)))}, _SHARD)


class Piece:
    """Some shards of the index, as a worker probes them."""

    def __init__(self, rows: list, shards: int):
        self.shards = shards
        self.held = {r["shard"]: (Levels(np.frombuffer(r["words"], "<u8"), np.frombuffer(r["starts"], "<i8")),
                                  np.frombuffer(r["prints"], "<u8"), np.frombuffer(r["counts"], "<u4"),
                                  np.frombuffer(r["last"], "<i8")) for r in rows}

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many documents hold each key (0: not in this piece), and the last of them."""
        counts, last = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        shard = (a >> np.uint64(33)).astype(np.int64) % self.shards
        order = np.argsort(shard, kind="stable")
        names, first = np.unique(shard[order], return_index=True)
        for name, of in zip(names.tolist(), np.split(order, first[1:])):
            if name in self.held:
                levels, prints, docs, lasts = self.held[name]
                slot = levels.slots(a[of], b[of])
                of, slot = of[slot >= 0], slot[slot >= 0]
                same = prints[slot] == b[of]
                counts[of[same]], last[of[same]] = docs[slot[same]], lasts[slot[same]]
        return counts, last


# ---- lines -----------------------------------------------------------------------------------------

def long_lines(data: bytes, min_chars: int) -> tuple[list[int], list[bytes]]:
    """Numbers and digests of the lines whose key has at least ``min_chars`` code points."""
    numbers, digests = [], []
    for i, line in enumerate(data.lower().split(b"\n")):
        if len(line) >= min_chars:
            key = line.strip(BLANKS)
            if len(key) >= 4 * min_chars or len(key) >= min_chars and len(key.decode("utf-8", "replace")) >= min_chars:
                numbers.append(i)
                digests.append(hashlib.blake2b(key, digest_size=16).digest())
    return numbers, digests


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """a, b (the digest of a line) and id, once for every document row that holds the line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, "text"):
            ids, digests = [], []
            for i, data in zip(part.column("id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                mine = set(long_lines(data, min_chars)[1])
                ids += [i] * len(mine)
                digests += mine
            a, b = _halves(digests)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                                              pa.array(ids, pa.int64())], ["a", "b", "id"])
    return docs.mapInArrow(run, "a long, b long, id long")


def build_index(docs: DataFrame, min_chars: int = MIN_CHARS) -> tuple[DataFrame, int]:
    """Shards of the index over the keys of at least two documents, and how many there are."""
    held = line_keys(docs, min_chars).groupBy("a", "b").agg(F.countDistinct("id").alias("docs"), F.max("id").alias("last"))
    held = materialize(held.where("docs >= 2"))
    shards = max(1, -(-held.count() // SHARD_KEYS))
    dealt = held.withColumn("shard", (F.shiftrightunsigned("a", 33) % shards).cast("int"))
    return materialize(dealt.groupBy("shard").applyInArrow(_build_shard, SHARD)), shards


def _pieces(index: DataFrame, shards: int) -> list[tuple[int, int]]:
    """Ranges of shards whose arrays the workers can hold (one shard at least)."""
    sizes = index.select("shard", sum((F.length(n) for n in _SHARD.names[2:]), F.lit(0)).alias("size")).collect()
    ranges, size = [], PIECE_BYTES
    for shard, more in sorted(map(tuple, sizes)):
        if size + more > PIECE_BYTES:
            ranges.append((shard, shard))
            size = 0
        ranges[-1] = (ranges[-1][0], shard)
        size += more
    return ranges


def _without(data: bytes, numbers: np.ndarray) -> tuple[bytes, int]:
    """The text without the lines of these numbers, and its number of lines before."""
    lines = data.split(b"\n")
    if not len(numbers):
        return data, len(lines)
    stays = np.ones(len(lines), bool)
    stays[numbers] = False
    return b"\n".join(compress(lines, stays)), len(lines)


MARKED = "doc_id long, id long, text string, dropped binary"
LEFT = "doc_id long, text string, n_lines long, n_dropped long"


def _probe(docs: DataFrame, piece: Piece, min_chars: int, min_docs: int, finish: bool) -> DataFrame:
    """Add to ``dropped`` the numbers of the lines that this piece takes out; ``finish``: take them out."""
    sent = docs.sparkSession.sparkContext.broadcast(piece)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, "text"):
            ids, texts = part.column("id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()
            found = [long_lines(data, min_chars) for data in texts]
            sizes = [len(n) for n, _ in found]
            counts, last = sent.value.find(*_halves([d for _, digests in found for d in digests]))
            gone = (counts >= min_docs) & (last != np.repeat(np.array(ids, np.int64), sizes))
            numbers, bounds = np.array([i for n, _ in found for i in n], "<i4"), np.cumsum([0, *sizes])
            marks = [old + numbers[lo:hi][gone[lo:hi]].tobytes()
                     for old, lo, hi in zip(part.column("dropped").to_pylist(), bounds, bounds[1:])]
            if not finish:
                yield part.set_column(part.schema.get_field_index("dropped"), "dropped", pa.array(marks, pa.binary()))
                continue
            left = [_without(data, np.frombuffer(m, "<i4")) for data, m in zip(texts, marks)]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array([t for t, _ in left], pa.binary()).cast(pa.string()),
                pa.array([n for _, n in left], pa.int64()), pa.array([len(m) // 4 for m in marks], pa.int64())],
                ["doc_id", "text", "n_lines", "n_dropped"])
    return docs.mapInArrow(run, LEFT if finish else MARKED)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text (what is left), n_lines (before) and n_dropped of every document; ``min_docs`` is two at least."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), whole_text().alias("text"),
                       F.lit(b"").alias("dropped"))
    index, shards = build_index(rows, min_chars)
    ranges = _pieces(index, shards) or [(0, -1)]
    for lo, hi in ranges:
        piece = Piece(index.where(F.col("shard").between(lo, hi)).collect(), shards)
        rows = _probe(rows if lo == ranges[0][0] else materialize(rows), piece, min_chars, max(2, min_docs), hi == ranges[-1][1])
    return rows


def op12(spark, sf_dir: str) -> DataFrame:
    left = dedup_lines(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
with d as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
x as (select r, doc_id, unnest(l) as line, generate_subscripts(l, 1) as p from d),
k as (select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from x),
c as (select key, max(coalesce(doc_id, -9223372036854775808)) as last from k where length(key) >= 40
      group by key having count(distinct coalesce(doc_id, -9223372036854775808)) >= 5),
j as (select r, doc_id, p, line, last is not null and last <> coalesce(doc_id, -9223372036854775808) as gone
      from k left join c using (key))
select any_value(doc_id) as doc_id, count(*) as n_lines, cast(sum(cast(gone as int)) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by p) filter (where not gone), '')) as kept_sha256
from j group by r"""
