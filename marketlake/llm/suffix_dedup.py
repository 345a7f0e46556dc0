"""Suffix-array removal of repeated byte strings.

Every byte covered by a ``LENGTH``-byte string that also starts earlier goes.  A sparse suffix array
serves: of the grams that a LENGTH-byte string holds, the one of smallest hash (leftmost on ties)
is its anchor, a choice that depends on the string's bytes alone, so equal strings have equal anchors
at equal offsets, and only suffixes at anchors need ordering.

1. ``anchors`` finds each text's anchors, the strings that each one stands for and a
   digest of the bytes they cover; within a part of some megabytes all but the first of equal ones are marked at
   once.
2. ``_classes`` sorts a bucket of anchors by (gram, digest, place): all but the first of a class are
   marked; a gram with several classes asks for its first occurrences' bytes.
3. ``_suffixes`` orders those bytes: to the right of the anchor as suffixes and, reversed, to its left,
   by deep-shallow sorting (multikey quicksort on eight-byte symbols to ``SHALLOW`` bytes, blind
   tries for groups that still agree).  Common-prefix lengths then tell which strings are equal, and
   all but the earliest are marked.
4. Marks are merged per document and the texts are cut.

A passage that fills a third of all documents is one anchor class with one row per part, folded as they come,
but the anchors near its ends cover other bytes in every document.  When a bucket of step 2 sees ``CROWD``
classes of a gram it hands the gram on, and all that comes of it later: its classes are dealt by their digests
and folded there, its bytes are dealt by place in step 3, where each part marks all but its own earliest of
equal strings; ``_strings`` then joins the parts by (gram, shift, string digest), where a string has at most one
row per part.  No list of such grams is kept anywhere; a request carries the mark.

Anchors travel packed, about one per 33 bytes of text; texts are shuffled once, for bytes
and cut alike.  Order: doc_id (null last), then start; rows that repeat an id with another
text come in the order of their digests, exact repeats of a row are the same document and are cut alike.
Null text is empty; texts shorter than LENGTH stay whole; empty tables give no rows; only doc_id and
text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import materialize, parts, ship, table, text_digest

LENGTH, GRAM = 100, 36
WIDTH = LENGTH - GRAM + 1
#: Bytes that multikey quicksort looks at before blind tries take over.
SHALLOW, SMALL = 64, 48
SLICE = 1 << 20
#: Text bytes whose anchors make up one bucket.
BUCKET_BYTES, LEAST_BUCKETS = 16 << 20, 24
#: Classes of a gram from which on it is dealt out, and anchors whose bytes make up one bucket of step 3.
CROWD, FETCHED = 16_384, 32_768
#: Text whose anchors, and anchors whose bytes, are in hand at a time; anchors that a bucket of step 2 takes in
#: before it folds them.
HAND_BYTES, HAND_ANCHORS, FOLD = 4 << 20, 8_192, 1 << 20
_POS = np.uint64((1 << 24) - 1)
_PRIME = 0x9E3779B97F4A7C15


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def powers(of: int) -> np.ndarray:
        steps = np.full(SLICE * 2 + 1024, of, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    mix = np.random.default_rng(6).integers(1, 2**63, 256, dtype=np.uint64)
    return powers(_PRIME), powers(pow(_PRIME, -1, 1 << 64)), mix


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _slice_anchors(data: np.ndarray, ends: np.ndarray):
    """(place, first string, last string, gram hash, cover digest) of the anchors in some texts
    laid end to end; ``ends`` are the texts' ends."""
    n = len(data)
    if n < LENGTH:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    up, down, table_ = _powers()
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(table_[data] * up[:n], out=prefix[1:])
    grams = _mix((prefix[GRAM:] - prefix[:-GRAM]) * down[: n - GRAM + 1])
    key = (grams & ~_POS) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size * 2 <= WIDTH:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < WIDTH:
        rest = WIDTH - size
        key = np.minimum(key[:-rest], key[rest:])
    starts = np.arange(n - LENGTH + 1)
    stop = np.repeat(ends, np.diff(np.concatenate([[0], ends])))[: len(starts)]
    starts = starts[starts + LENGTH <= stop]
    if not len(starts):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    at = (key[starts] & _POS).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    first, last = starts[new], starts[np.concatenate([new[1:], [len(starts)]]) - 1]
    place = at[new]
    cover = (prefix[last + LENGTH] - prefix[first]) * down[first]
    cover = _mix(cover + (place - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                 + (last - first).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return place, first, last, grams[place], cover


def anchors(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Anchors of whole texts: row, place, back (to the first string), more (strings), gram, cover."""
    out = {k: [] for k in ("row", "place", "back", "more", "gram", "cover")}

    def add(part: list[tuple[int, int, bytes]]) -> None:
        data = np.frombuffer(b"".join(p[2] for p in part), np.uint8)
        ends = np.cumsum([len(p[2]) for p in part])
        place, first, last, gram, cover = _slice_anchors(data, ends)
        owner = np.searchsorted(ends, first, "right")
        shift = np.array([p[1] for p in part]) - np.concatenate([[0], ends[:-1]])
        out["row"].append(np.array([p[0] for p in part], np.int64)[owner])
        out["place"].append(place + shift[owner])
        out["back"].append(place - first)
        out["more"].append(last - first)
        out["gram"].append(gram)
        out["cover"].append(cover)

    part, size = [], 0
    for row, text in enumerate(texts):
        # a very long text is read in slices that share LENGTH - 1 bytes, so no string is missed
        for lo in range(0, max(1, len(text) - LENGTH + 1), SLICE):
            piece = text[lo: lo + SLICE + LENGTH - 1]
            if part and size + len(piece) > SLICE:
                add(part)
                part, size = [], 0
            part.append((row, lo, piece))
            size += len(piece)
    if part:
        add(part)
    kinds = {"gram": np.uint64, "cover": np.uint64}
    return {k: np.concatenate(v) if v else np.empty(0, kinds.get(k, np.int64)) for k, v in out.items()}


# ---- packed rows: the documents named once, then one number array per field ----

_DOC = ("null", "id", "digest")


def _pack(bucket: np.ndarray, docs: np.ndarray, doc: np.ndarray, fields: dict[str, np.ndarray]) -> list[dict]:
    """One row per bucket.  docs: (null, id, digest) rows; doc: which one each item belongs to."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    rows = []
    for part in np.split(order, cuts) if len(order) else []:
        used, index = np.unique(doc[part], return_inverse=True)
        rows.append({"bucket": int(bucket[part[0]]), "docs": docs[used].tobytes(), "doc": index.astype("<u4").tobytes()}
                    | {k: v[part].tobytes() for k, v in fields.items()})
    return rows


def _unpack(rows: pa.Table | list[dict], kinds: dict[str, str]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    docs, doc, fields, base = [], [], {k: [] for k in kinds}, 0
    for row in rows.to_pylist() if isinstance(rows, pa.Table) else rows:
        own = np.frombuffer(row["docs"], "<i8").reshape(-1, 3)
        docs.append(own)
        doc.append(np.frombuffer(row["doc"], "<u4").astype(np.int64) + base)
        base += len(own)
        for k, t in kinds.items():
            fields[k].append(np.frombuffer(row[k], t))
    docs, doc = np.concatenate(docs), np.concatenate(doc)
    docs, again = np.unique(docs, axis=0, return_inverse=True)   # sorted by (null, id, digest): the index is the rank
    return docs, again.reshape(-1)[doc], {k: np.concatenate(v) for k, v in fields.items()}


def _schema(kinds: dict[str, str]) -> str:
    return "bucket long, docs binary, doc binary, " + ", ".join(f"{k} binary" for k in kinds)


def _batch(rows: list[dict], kinds: dict[str, str]) -> pa.Table:
    names = ["bucket", "docs", "doc", *kinds]
    types = [pa.int64()] + [pa.binary()] * (len(names) - 1)
    return pa.Table.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names)


ANCHOR = {"gram": "<u8", "cover": "<u8", "place": "<u4", "back": "<u1", "more": "<u1"}
#: kind 0: bytes [start, start + size) are marked; kind 1: the anchor at start wants its bytes; kind 2: so does
#: this one, of a crowded gram.
MARK = {"kind": "<u1", "start": "<u4", "size": "<u4", "back": "<u1", "more": "<u1"}
#: The string that begins ``shift`` bytes before the anchor at place.
STRING = {"gram": "<u8", "digest": "<u8", "place": "<u4", "shift": "<u1"}
SUFFIX = {"place": "<u4", "back": "<u1", "more": "<u1", "data": "|S1"}


def _document(docs: np.ndarray) -> np.ndarray:
    return _mix((docs[:, 1] * 3 + docs[:, 0] + docs[:, 2] * 5).view(np.uint64))


def _spread(docs: np.ndarray, buckets: int) -> np.ndarray:
    """The part of each document (row of docs)."""
    return (_document(docs) % np.uint64(buckets)).astype(np.int64)


def _dealt(gram: np.ndarray, other: np.ndarray, crowd: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each anchor: by gram; where ``crowd``, by ``other`` too, from ``buckets`` on."""
    mixed = _mix(gram + np.uint64(1))
    mixed = np.where(crowd, _mix(mixed ^ other), mixed)
    return (mixed % np.uint64(buckets)).astype(np.int64) + crowd * buckets


def _marks(docs: np.ndarray, doc: np.ndarray, kind, start, size, back, more, buckets: int) -> list[dict]:
    return _pack(_spread(docs, buckets)[doc], docs, doc, {
        "kind": kind.astype("<u1"), "start": start.astype("<u4"), "size": size.astype("<u4"),
        "back": back.astype("<u1"), "more": more.astype("<u1")})


def _later(order: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(items sorted by keys then order, is the first of its keys, comes later than that first)."""
    by = np.lexsort((order, *keys))
    change = np.zeros(len(by), bool)
    change[:1] = True
    for k in keys:
        s = k[by]
        change[1:] |= s[1:] != s[:-1]
    head = np.flatnonzero(change)[np.cumsum(change) - 1]
    return by, change, order[by] > order[by][head]


def _find_anchors(buckets: int):
    """Texts -> packed anchors by gram (side 0) and marks of those that a part repeats (side 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "data", most=HAND_BYTES):
            docs = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in _DOC], axis=1)
            a = anchors([t or b"" for t in batch.column("data").to_pylist()])
            if not len(a["row"]):
                continue
            ranked, rank = np.unique(docs, axis=0, return_inverse=True)
            doc = rank.reshape(-1)[a["row"]]
            place = a["place"]
            by, first, later = _later(doc << 32 | place, a["cover"], a["gram"])
            keep, again = by[first], by[later]
            rows = [r | {"side": 0} for r in _pack(_dealt(a["gram"][keep], a["cover"][keep], np.zeros(len(keep), bool), buckets),
                                                   ranked, doc[keep], {k: a[k][keep].astype(t) for k, t in ANCHOR.items()})]
            start = place[again] - a["back"][again]
            zero = np.zeros(len(again), np.int64)
            rows += [r | {"side": 1} for r in _marks(ranked, doc[again], zero, start, a["more"][again] + LENGTH, zero, zero, buckets)]
            yield from _sides(rows, ANCHOR).to_batches()
    return run


def _sides(rows: list[dict], kinds: dict[str, str]) -> pa.Table:
    """Packed rows of ``kinds`` (side 0) and of marks (side 1)."""
    names = ["side", "bucket", "docs", "doc", *dict.fromkeys([*kinds, *MARK])]
    arrays = [pa.array([r.get(n) for r in rows], pa.int64() if n in ("side", "bucket") else pa.binary()) for n in names]
    return pa.Table.from_arrays(arrays, names)


class Fold:
    """The anchors of one bucket as they come: of equal (gram, cover) only the earliest stays, and a gram that
    reaches ``crowd`` classes (None: never) is handed on, what comes of it later too.  Holds about ``FOLD`` anchors
    or twice the classes of the grams that are not crowded."""

    def __init__(self, buckets: int, crowd: int | None):
        self.buckets, self.crowd, self.limit = buckets, crowd, FOLD
        self.rows: list[dict] = []
        self.n, self.crowds = 0, np.empty(0, np.uint64)

    def add(self, row: dict) -> list[dict]:
        self.rows.append(row)
        self.n += len(row["doc"]) // 4
        return self.fold()[0] if self.n >= self.limit else []

    def fold(self):
        """(rows that are done with, what is held: documents, document of each, fields, by gram)."""
        docs, doc, a = _unpack(self.rows, ANCHOR)
        place, back, more = (a[k].astype(np.int64) for k in ("place", "back", "more"))
        by, first, later = _later(doc << 32 | place, a["cover"], a["gram"])
        again, keep = by[later], by[first]
        zero = np.zeros(len(again), np.int64)
        out = [r | {"side": 1} for r in _marks(docs, doc[again], zero, place[again] - back[again], more[again] + LENGTH,
                                               zero, zero, self.buckets)]
        if self.crowd is not None:
            names, classes = np.unique(a["gram"][keep], return_counts=True)
            self.crowds = np.union1d(self.crowds, names[classes >= self.crowd])
            crowd = np.isin(a["gram"][keep], self.crowds)
            gone, keep = keep[crowd], keep[~crowd]
            out += [r | {"side": 0} for r in _pack(_dealt(a["gram"][gone], a["cover"][gone], np.ones(len(gone), bool), self.buckets),
                                                   docs, doc[gone], {k: v[gone] for k, v in a.items()})]
        a, doc = {k: v[keep] for k, v in a.items()}, doc[keep]
        self.rows = _pack(np.zeros(len(keep), np.int64), docs, doc, a)
        self.n = len(keep)
        self.limit = max(self.limit, 2 * self.n)
        return out, docs, doc, a

    def finish(self) -> list[dict]:
        """What is left: a gram with several classes, and any dealt one, asks for its first occurrences' bytes."""
        if not self.rows:
            return []
        out, docs, doc, a = self.fold()
        g = a["gram"]
        several = np.full(len(g), self.crowd is None)
        several[1:] |= g[1:] == g[:-1]
        several[:-1] |= g[1:] == g[:-1]
        back, more = (a[k][several].astype(np.int64) for k in ("back", "more"))
        kind = np.full(len(more), 2 if self.crowd is None else 1)
        return out + [r | {"side": 1} for r in _marks(docs, doc[several], kind, a["place"][several], more + LENGTH, back, more,
                                                      self.buckets)]


def _classes(buckets: int, crowd: int | None):
    """Rows by bucket -> marks of repeated classes and requests for bytes (side 1), anchors of crowded grams dealt by
    their digests (side 0); marks pass through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, Fold(buckets, crowd)
        for batch in batches:
            for i in range(batch.num_rows):
                side, name = batch.column("side")[i].as_py(), batch.column("bucket")[i].as_py()
                if side == 1:
                    yield batch.slice(i, 1)
                    continue
                if name != bucket:
                    yield from _sides(held.finish(), ANCHOR).to_batches()
                    bucket, held = name, Fold(buckets, crowd)
                done = held.add(batch.slice(i, 1).to_pylist()[0])
                if done:
                    yield from _sides(done, ANCHOR).to_batches()
        yield from _sides(held.finish(), ANCHOR).to_batches()
    return run


def _merge(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals per document; touching ones join."""
    if not len(doc):
        return doc, start, end
    by = np.lexsort((start, doc))
    doc, start, end = doc[by], start[by], end[by]
    reach = np.maximum.accumulate(end + (doc << 34))
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + (doc[1:] << 34) > reach[:-1]
    heads = np.flatnonzero(new)
    tails = np.concatenate([heads[1:], [len(doc)]]) - 1
    return doc[heads], start[heads], (reach[tails] - (doc[tails] << 34))


def _per_document(tbl: pa.Table) -> pa.Table:
    """Marks of some documents -> one row each: merged intervals, requests."""
    docs, doc, m = _unpack(tbl, MARK)
    start, size = m["start"].astype(np.int64), m["size"].astype(np.int64)
    cut = m["kind"] == 0
    d, lo, hi = _merge(doc[cut], start[cut], start[cut] + size[cut])
    spans = np.stack([lo, hi], axis=1).astype("<i8")
    by = np.lexsort((start[~cut], doc[~cut]))
    ask_doc = doc[~cut][by]
    asks = np.stack([start[~cut], m["back"][~cut], m["more"][~cut], m["kind"][~cut] == 2], axis=1).astype("<i8")[by]
    crowded = np.bincount(ask_doc, asks[:, 3], len(docs)).astype(np.int64)
    every = np.arange(len(docs))
    a, b = np.searchsorted(d, every), np.searchsorted(d, every, "right")
    e, f = np.searchsorted(ask_doc, every), np.searchsorted(ask_doc, every, "right")
    return pa.table({"null": docs[:, 0], "id": docs[:, 1], "digest": docs[:, 2],
                     "spans": pa.array([spans[x:y].tobytes() for x, y in zip(a, b)], pa.binary()),
                     "asks": pa.array([asks[x:y].tobytes() if y > x else None for x, y in zip(e, f)], pa.binary()),
                     "crowded": pa.array(crowded)})


def _fetch(buckets: int):
    """Documents with requests -> packed bytes around their anchors, by gram; some thousand anchors at a time."""
    size = WIDTH - 1 + LENGTH

    def packed(docs: np.ndarray, held: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        up, down, mix = _powers()
        doc = np.concatenate([np.full(len(asks), i) for i, asks, _ in held])
        asks, data = (np.concatenate([h[k] for h in held]) for k in (1, 2))
        gram = data[:, WIDTH - 1: WIDTH - 1 + GRAM].astype(np.int64)
        h = (mix[gram] * up[:GRAM]).sum(axis=1, dtype=np.uint64)
        where = _mix(_document(docs)[doc] + asks[:, 0].astype(np.uint64))
        rows = _pack(_dealt(_mix(h), where, asks[:, 3] == 1, buckets), docs, doc, {
            "place": asks[:, 0].astype("<u4"), "back": asks[:, 1].astype("<u1"), "more": asks[:, 2].astype("<u1"), "data": data})
        yield from _batch(rows, SUFFIX).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "data", most=HAND_BYTES):
            docs = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in _DOC], axis=1)
            held, n = [], 0
            for i, (text, wants) in enumerate(zip(batch.column("data").to_pylist(), batch.column("asks").to_pylist())):
                own, wants = np.frombuffer(text, np.uint8), np.frombuffer(wants, "<i8").reshape(-1, 4)
                for lo in range(0, len(wants), HAND_ANCHORS):
                    asks = wants[lo: lo + HAND_ANCHORS]
                    # columns: WIDTH - 1 bytes before the anchor, LENGTH from it on; outside its strings zero
                    at = asks[:, 0:1] + np.arange(size)[None, :] - (WIDTH - 1)
                    first = asks[:, 0:1] - asks[:, 1:2]
                    inside = (at >= first) & (at < first + asks[:, 2:3] + LENGTH)
                    held.append((i, asks, np.where(inside, own[np.clip(at, 0, len(own) - 1)], 0).astype(np.uint8)))
                    n += len(asks)
                    if n >= HAND_ANCHORS:
                        yield from packed(docs, held)
                        held, n = [], 0
            if held:
                yield from packed(docs, held)
    return run


class BlindTrie:
    """Orders byte strings that share a long prefix: inner nodes keep only the depth at which their
    strings part and the parting bytes, so a string is compared once, with the leaf it falls to."""

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None

    def add(self, i: int) -> None:
        s, node = self.strings[i], self.root
        if node is None:
            self.root = [i]
            return
        while isinstance(node, tuple):
            node = node[1].get(s[node[0]: node[0] + 1]) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        if s == other:
            node.append(i)
            return
        n, lo, hi = min(len(s), len(other)), 0, min(len(s), len(other))
        while lo < hi:   # longest common prefix by halving
            mid = (lo + hi + 1) // 2
            if s[lo:mid] == other[lo:mid]:
                lo = mid
            else:
                hi = mid - 1
        parent, edge, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < lo:
            parent, edge = node, s[node[0]: node[0] + 1]
            node = node[1][edge]
        if isinstance(node, tuple) and node[0] == lo:
            node[1][s[lo: lo + 1]] = [i]
            return
        split = (lo, {other[lo: lo + 1]: node, s[lo: lo + 1]: [i]})
        if parent is None:
            self.root = split
        else:
            parent[1][edge] = split

    def ordered(self) -> Iterator[int]:
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                yield from node


def deep_shallow(matrix: np.ndarray) -> np.ndarray:
    """Order of the rows of a byte matrix (strings padded with zeros)."""
    n, width = matrix.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = matrix
    symbols = padded.view(">u8").astype(np.uint64)
    limit = min(SHALLOW // 8, symbols.shape[1])
    raw = padded.tobytes()
    row = padded.shape[1]
    out: list[np.ndarray] = []
    stack: list[tuple[np.ndarray, int]] = [(np.arange(n), 0)]
    while stack:
        items, depth = stack.pop()
        if len(items) <= 1:
            out.append(items)
        elif len(items) <= SMALL and depth < limit:
            out.append(np.array(sorted(items.tolist(), key=lambda i: raw[i * row:(i + 1) * row])))
        elif depth >= limit:   # deep: the group agrees on all shallow bytes
            strings = [raw[i * row + depth * 8:(i + 1) * row].rstrip(b"\0") for i in items.tolist()]
            trie = BlindTrie(strings)
            for k in range(len(strings)):
                trie.add(k)
            out.append(items[np.fromiter(trie.ordered(), np.int64, len(items))])
        else:                  # shallow: three-way split on the next symbol
            keys = symbols[items, depth]
            pivot = np.partition(keys[:: max(1, len(keys) // 63)], len(keys[:: max(1, len(keys) // 63)]) // 2)[
                len(keys[:: max(1, len(keys) // 63)]) // 2]
            stack += [(items[keys > pivot], depth), (items[keys == pivot], depth + 1), (items[keys < pivot], depth)]
    return np.concatenate(out) if out else np.empty(0, np.int64)


def common_prefixes(matrix: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row of the order shares with the one before."""
    out = np.zeros(len(order), np.int64)
    for lo in range(1, len(order), 16_384):
        hi = min(len(order), lo + 16_384)
        differ = matrix[order[lo:hi]] != matrix[order[lo - 1: hi - 1]]
        out[lo:hi] = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
    return out


def _suffixes(buckets: int, fetched: int, strings: int):
    """Anchor bytes of some grams -> marks of all but the earliest of equal strings (side 1); of
    crowded grams (buckets from ``fetched`` on) also those earliest strings (side 0)."""
    def run(tbl: pa.Table) -> pa.Table:
        crowded = tbl.column("bucket")[0].as_py() >= fetched
        docs, doc, s = _unpack(tbl, SUFFIX)
        place, back, more = (s[k].astype(np.int64) for k in ("place", "back", "more"))
        data = np.frombuffer(s["data"].tobytes(), np.uint8).reshape(len(place), -1)
        right, left = data[:, WIDTH - 1:], data[:, : WIDTH - 1][:, ::-1]
        when = doc << 32 | place
        sides = []
        for matrix in (right, left):
            by = deep_shallow(matrix)
            sides.append((by, common_prefixes(matrix, by)))
        marked = np.zeros((len(place), WIDTH), bool)
        (by_r, lcp_r), (by_l, lcp_l) = sides
        earliest = []
        right_class, left_class = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
        for shift in range(WIDTH):   # strings that begin `shift` bytes before their anchor
            rows = np.flatnonzero((back - more <= shift) & (shift <= back))
            if len(rows) < 2 and not crowded:
                continue
            right_class[by_r] = np.cumsum(lcp_r < LENGTH - shift)
            left_class[by_l] = np.cumsum(lcp_l < shift)
            by, first, later = _later(when[rows], left_class[rows], right_class[rows])
            marked[rows[by[later]], shift] = True
            if crowded:
                earliest.append(rows[by[first]])
        edge = np.diff(np.pad(marked, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        item, lo = np.nonzero(edge == 1)
        _, hi = np.nonzero(edge == -1)
        start = place[item] - (hi - 1)
        zero = np.zeros(len(item), np.int64)
        found = [r | {"side": 1} for r in _marks(docs, doc[item], zero, start, hi - 1 - lo + LENGTH, zero, zero, buckets)]
        if crowded:
            up, down, mix = _powers()
            prefix = np.zeros((len(place), data.shape[1] + 1), np.uint64)
            np.cumsum(mix[data] * up[: data.shape[1]], axis=1, out=prefix[:, 1:])
            grams = _mix((prefix[:, WIDTH - 1 + GRAM] - prefix[:, WIDTH - 1]) * down[WIDTH - 1])
            shift = np.repeat(np.arange(WIDTH), [len(e) for e in earliest])
            digest = np.concatenate([
                _mix((prefix[e, WIDTH - 1 - k + LENGTH] - prefix[e, WIDTH - 1 - k]) * down[WIDTH - 1 - k])
                for k, e in enumerate(earliest)])
            item = np.concatenate(earliest)
            where = _mix(_mix(grams[item] + shift.astype(np.uint64)) ^ digest) % np.uint64(strings)
            found += [r | {"side": 0} for r in _pack(where.astype(np.int64), docs, doc[item], {
                "gram": grams[item], "digest": digest, "place": place[item].astype("<u4"), "shift": shift.astype("<u1")})]
        return _sides(found, STRING)
    return run


def _strings(buckets: int):
    """Each part's earliest strings of crowded grams -> marks of all but the earliest of all; marks pass through."""
    def run(tbl: pa.Table) -> pa.Table:
        side = np.array(tbl.column("side").to_pylist())
        passed = tbl.filter(pa.array(side == 1)).select(["bucket", "docs", "doc", *MARK])
        if (side == 1).all():
            return passed
        docs, doc, s = _unpack(tbl.filter(pa.array(side == 0)), STRING)
        place = s["place"].astype(np.int64)
        by, _, later = _later(doc << 32 | place, s["digest"], s["shift"], s["gram"])
        again = by[later]
        start = place[again] - s["shift"][again]
        d, lo, hi = _merge(doc[again], start, start + LENGTH)
        zero = np.zeros(len(d), np.int64)
        found = _batch(_marks(docs, d, zero, lo, hi - lo, zero, zero, buckets), MARK)
        return pa.concat_tables([found, passed.cast(found.schema)])
    return run


def _cut(readable: bool):
    """Texts and their marks -> ``kept``, n_removed, n_spans.  ``readable``: kept as text; what is
    left of a character that was cut goes too."""
    names = ["spans", "more_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "data"):
            keep = [n for n in batch.schema.names if n not in ("data", *names)]
            kept, removed, runs = [], [], []
            for text, *found in zip(batch.column("data").to_pylist(), *[batch.column(n).to_pylist() for n in names]):
                text = text or b""
                both = np.concatenate([np.frombuffer(f or b"", "<i8").reshape(-1, 2) for f in found])
                _, lo, hi = _merge(np.zeros(len(both), np.int64), both[:, 0], both[:, 1])
                edges = [0, *np.stack([lo, hi], axis=1).reshape(-1).tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                removed.append(int((hi - lo).sum()))
                runs.append(len(lo))
            kept = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if readable else pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in keep] + [kept, pa.array(removed, pa.int64()), pa.array(runs, pa.int64())],
                [*keep, "kept", "n_removed", "n_spans"])
    return run


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, digest, ``kept`` (binary: the remaining bytes), n_bytes, n_removed and n_spans."""
    return _removed(docs, False).select(
        F.when(F.col("null") == 0, F.col("id")).alias("doc_id"), "digest",
        (F.length("kept") + F.col("n_removed")).cast("long").alias("n_bytes"), "n_removed", "n_spans", "kept")


def _removed(docs: DataFrame, carry: bool) -> DataFrame:
    """The row's key, ``kept``, n_removed, n_spans; ``carry``: kept is text, and ``row`` is the whole
    input row as a struct."""
    spark = docs.sparkSession
    ship(spark)
    keys = [F.col("doc_id").isNull().cast("long").alias("null"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
            text_digest().alias("digest")]
    data = F.col("text").cast("binary").alias("data")
    texts = docs.select(*keys, data)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))

    both, strings_too = dict.fromkeys([*ANCHOR, *MARK]), dict.fromkeys([*STRING, *MARK])
    per = "null long, id long, digest long, spans binary, asks binary, crowded long"

    def by_bucket(df: DataFrame, n: int):
        """Groups of a bucket; as many partitions as buckets, so a task's share does not grow with the input."""
        return df.repartition(n, "bucket").groupBy("bucket")

    def folded(df: DataFrame, n: int, crowd: int | None) -> DataFrame:
        """Step 2 as a stream: rows come bucket after bucket and are folded as they come."""
        return df.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_classes(buckets, crowd), "side long, " + _schema(both))

    # side 0: anchors in their gram's bucket; side 1: marks that are known already, passed on
    marks = materialize(folded(texts.mapInArrow(_find_anchors(buckets), "side long, " + _schema(both)), buckets, CROWD))
    if not marks.where("side = 0").isEmpty():
        marks = folded(marks, 2 * buckets, None)
    marks = materialize(by_bucket(marks.select("bucket", "docs", "doc", *MARK), buckets).applyInArrow(_per_document, per))
    wanted, crowded = marks.agg(F.sum(F.octet_length("asks")), F.sum("crowded")).first()
    fetched = max(buckets, -(-(wanted or 0) // (32 * FETCHED)))
    strings = max(buckets, -(-(crowded or 0) // CROWD))
    known = texts.join(marks.where("asks is not null").select(*_DOC, "asks"), list(_DOC)).mapInArrow(_fetch(fetched), _schema(SUFFIX))
    known = by_bucket(known, 2 * fetched if crowded else fetched).applyInArrow(
        _suffixes(buckets, fetched, strings), "side long, " + _schema(strings_too))
    if crowded:
        known = by_bucket(known, strings).applyInArrow(_strings(buckets), _schema(MARK))
    asked = by_bucket(known.select("bucket", "docs", "doc", *MARK), buckets).applyInArrow(_per_document, per).select(
        *_DOC, F.col("spans").alias("more_spans"))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    joined = (docs.select(*keys, data, *row).join(marks.select(*_DOC, "spans"), list(_DOC), "left")
              .join(asked, list(_DOC), "left").select(*_DOC, *(["row"] if carry else []), "data", "spans", "more_spans"))
    schema = StructType([f for f in joined.schema.fields if f.name not in ("data", "spans", "more_spans")]
                        + [StructField("kept", StringType() if carry else BinaryType()), StructField("n_removed", LongType()),
                           StructField("n_spans", LongType())])
    return joined.mapInArrow(_cut(carry), schema)


def op6(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def cut_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without their repeated bytes.

    A cut may fall inside a character; what is left of such a character goes too.  Null texts stay
    null; n_chars, if there, follows the new text; documents stay even when nothing of them is left."""
    found = _removed(docs, True)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept"))
    new = {"text": text, "n_chars": F.char_length(text).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return found.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
