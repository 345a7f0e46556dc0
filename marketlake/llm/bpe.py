"""Byte-level BPE by segment trees.

Every match of the pre-token pattern is merged on its own.  Its tree has one leaf per byte
position; a leaf holds ``rank * width + position`` of the pair that starts there, an inner node
the smaller of its children, so the root names the leftmost pair of lowest rank.  A merge changes
three leaves (the pair's, the absorbed neighbour's and the previous neighbour's), each a
logarithmic climb.  Short matches of one width run side by side as the rows of one array (a forest
that takes one merge per tree and round); matches over 64 bytes have a tree of their own, so
a long unbroken run costs n log n.

Pre-tokens are found and deduplicated per slice of about a million characters; merged results are
kept per worker with their bytes in a table of at most ``CACHE`` entries and about ``CACHE_BYTES`` (cost
bounds only: it is emptied when full).  A digest finds an entry; the bytes then decide, and matches that
share another's digest go by their bytes.  Null text counts as empty; repeated rows and any doc_id, null included, are encoded row
by row; other columns are not touched.  Memory is bounded by a slice or the longest text (about 60 bytes a
character of it; a worker keeps the power tables of the longest it has seen, 16 bytes a character).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import parts, ship, whole_text

RANKS = "byte_bpe_50k.tiktoken"
CACHE, CACHE_BYTES = 400_000, 32 << 20
#: Matches of more bytes are compared one by one.
LONG = 512
SLICE = 1_000_000
FOREST = 64
#: Tree leaves that one array of trees holds.
CELLS = 1 << 17
# Character classes of the pattern; END stands between texts.
LETTER, NUMBER, BLANK, OTHER, END = 1, 2, 3, 4, 5


@lru_cache(1)
def _classes() -> np.ndarray:
    import regex

    table = np.full(0x110000, OTHER, np.uint8)
    chars = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
        for m in regex.finditer(pattern, chars):
            table[[ord(c) for c in m.group()]] = kind
    return table


def pretoken_starts(cps: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin in a slice (code points and their classes); a text's end
    is a character of class END, which is a start of its own."""
    n = len(cps)
    start = np.ones(n, bool)
    start[1:] = kinds[1:] != kinds[:-1]
    start[kinds == END] = True
    blank = kinds == BLANK
    # the last blank of a run before a visible character goes its own way: a space joins what
    # follows, any other blank is a match alone
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & (kinds[1:] != END))
    start[last] = True
    space = last[cps[last] == 0x20]
    start[space + 1] = False
    # contractions, only where a match begins with the apostrophe
    quote = np.flatnonzero((cps[:-1] == 0x27) & start[:-1])
    if len(quote):
        nxt = np.concatenate([cps, np.zeros(3, cps.dtype)])
        a, b = nxt[quote + 1], nxt[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = np.zeros(len(quote), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (a == ord(x)) & (b == ord(y))
        for at, size in ((quote[one], 2), (quote[two & ~one], 3)):
            start[at + 1] = False
            rest = at + size
            rest = rest[rest < n]
            start[rest] = True
            # a blank run's rules stand; letters after the contraction start a match of their own
    return np.flatnonzero(start)


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array with room for ``n`` items."""
    while n > len(array):
        array = np.concatenate([array, np.zeros_like(array)])
    return array


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as one number (the last eight positions have none)."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, 0, (1,))


def differ(a: np.ndarray, at_a: np.ndarray, sizes: np.ndarray, b: np.ndarray, at_b: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Which of the byte strings a[at_a: + sizes] and b[at_b: + sizes_b] are not equal; eight bytes at a time
    for all strings at once, the few over ``LONG`` bytes each as a whole."""
    if len(a) < 8:
        a = np.concatenate([a, np.zeros(8, np.uint8)])
    bad = sizes != sizes_b
    for i in np.flatnonzero(~bad & (sizes > LONG)).tolist():
        x, y, n = int(at_a[i]), int(at_b[i]), int(sizes[i])
        bad[i] = not np.array_equal(a[x: x + n], b[y: y + n])
    live, done = np.flatnonzero(~bad & (sizes <= LONG)), 0
    at_end, a8, b8 = len(a) - 8, _words(a), _words(b)
    while len(live):
        left = np.minimum(sizes[live] - done, 8)
        x = at_a[live] + done
        back = np.maximum(x - at_end, 0)          # the slice has no eight bytes there: read from before
        low = a8[x - back] >> (back.astype(np.uint64) << np.uint64(3))
        mask = ~np.uint64(0) >> ((np.uint64(8) - left.astype(np.uint64)) << np.uint64(3))
        wrong = (low ^ b8[at_b[live] + done]) & mask != 0
        bad[live[wrong]] = True
        done += 8
        live = live[~wrong & (sizes[live] > done)]
    return bad


class Bpe:
    """Encoder and decoder for one file of ranks."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            self.tokens[r] = t
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.pairs: dict[int, int] = {}
        self.token_sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        rng = np.random.default_rng(20)
        self.byte_mix = rng.integers(1, 2**63, 256, dtype=np.uint64)
        self.powers = self.inverses = np.empty(0, np.uint64)
        #: Slot of each digest, and of the words whose digest another word has.
        self.known: dict[int, int] = {}
        self.odd: dict[bytes, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.known.clear()
        self.odd.clear()
        self.slots = self.used = self.kept = 0
        self.ids = np.empty(1 << 16, np.uint32)
        self.store = np.zeros(1 << 16, np.uint8)
        self.begin, self.count, self.at, self.size = (np.empty(1 << 14, np.int64) for _ in range(4))

    def _find_pairs(self) -> None:
        """The pairs of ids that make a token, and an open-addressing table of them."""
        for t, r in self.ranks.items():
            for i in range(1, len(t)):
                a, b = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if a is not None and b is not None:
                    self.pairs[a << 20 | b] = r
        keys = np.array(list(self.pairs), np.int64)
        ranks = np.array(list(self.pairs.values()), np.int32)
        self.shift = np.uint64(64 - (len(keys) * 6).bit_length())
        self.slot_keys = np.full((1 << int(64 - self.shift)) + 256, -1, np.int64)
        self.slot_ranks = np.full(len(self.slot_keys), -1, np.int32)
        at = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.slot_keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.slot_keys[at[put]], self.slot_ranks[at[put]] = keys[put], ranks[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, ranks, at = keys[rest], ranks[rest], at[rest] + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 where the pair is no token."""
        key = (a.astype(np.int64) << 20) | b
        at = self._slot(key)
        seen = self.slot_keys.take(at)
        out = np.where(seen == key, self.slot_ranks.take(at), np.int32(-1))
        more = np.flatnonzero((seen != key) & (seen >= 0))
        while len(more):
            at[more] += 1
            seen = self.slot_keys.take(at[more])
            hit = seen == key[more]
            out[more[hit]] = self.slot_ranks.take(at[more[hit]])
            more = more[~hit & (seen >= 0)]
        return out

    def forest(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge many matches of at most ``width`` bytes; their ids one after another, and counts."""
        m, bits, inf = len(starts), width.bit_length() - 1, np.int32(2**31 - 1)
        row = width + 1                      # one place past the end stands for "no neighbour"
        at = np.arange(row, dtype=np.int32)
        inside = at[None, :] < sizes[:, None]
        token = np.full((m, row), -1, np.int32)
        token[inside] = self.byte_id[data[(starts[:, None] + at[None, :])[inside]]]
        after = np.minimum(at + 1, np.where(at + 1 < sizes[:, None], at + 1, width)).astype(np.int32)
        before = np.broadcast_to(at - 1, (m, row)).copy()
        tree = np.full((m, 2 * width), inf, np.int32)
        if width > 1:
            ok = inside[:, 1:width]
            r = np.full(ok.shape, -1, np.int32)
            r[ok] = self._rank(token[:, : width - 1][ok], token[:, 1:width][ok])
            tree[:, width: 2 * width - 1] = np.where(r >= 0, (r << bits) | at[: width - 1], inf)
            for level in range(bits - 1, -1, -1):
                lo = 1 << level
                tree[:, lo: 2 * lo] = np.minimum(tree[:, 2 * lo: 4 * lo: 2], tree[:, 2 * lo + 1: 4 * lo: 2])
        token_, after_, before_, tree_ = (x.reshape(-1) for x in (token, after, before, tree))
        live = np.flatnonzero(tree[:, 1] < inf) if width > 1 else np.empty(0, np.int64)
        while len(live):
            base, own = live * (2 * width), live * row
            root = tree_.take(base + 1)
            p, new = root & (width - 1), root >> bits
            q = after_.take(own + p)
            r = after_.take(own + q)
            o = before_.take(own + p)
            token_[own + p] = new
            token_[own + q] = -1
            after_[own + p] = r
            before_[own + r] = p
            has = o >= 0
            o = np.where(has, o, p)
            # both pairs that touch the merged token, ranked together
            n = len(live)
            ranks = self._rank(np.concatenate([new, token_.take(own + o)]), np.concatenate([token_.take(own + r), new]))
            right = np.where((r < width) & (ranks[:n] >= 0), (ranks[:n] << bits) | p, inf)
            left = np.where(ranks[n:] >= 0, (ranks[n:] << bits) | o, inf)
            tree_[base + (width + q)] = inf
            tree_[base + (width + o)] = left
            tree_[base + (width + p)] = right   # also where there is no neighbour before
            node = (width + np.concatenate([q, p, o])) >> 1
            base = np.concatenate([base, base, base])
            for _ in range(bits):
                child = base + 2 * node
                tree_[base + node] = np.minimum(tree_.take(child), tree_.take(child + 1))
                node = node >> 1
            live = live[tree_.take(live * (2 * width) + 1) < inf]
        kept = token[:, :width] >= 0
        return token[:, :width][kept], kept.sum(axis=1)

    def tree(self, piece: bytes) -> list[int]:
        """Merge one long match."""
        if not self.pairs:
            self._find_pairs()
        n = len(piece)
        width = 1 << max(1, (n - 1).bit_length())
        bits, inf = width.bit_length() - 1, 1 << 62
        token = [int(self.byte_id[b]) for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [inf] * (2 * width)
        for i in range(n - 1):
            r = self.pairs.get(token[i] << 20 | token[i + 1])
            if r is not None:
                tree[width + i] = r << bits | i
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(leaf: int, value: int) -> None:
            node = width + leaf
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                low = a if a < b else b
                if tree[node] == low:
                    return
                tree[node] = low
                node >>= 1

        while tree[1] < inf:
            p, new = tree[1] & (width - 1), tree[1] >> bits
            q, o = after[p], before[p]
            r = after[q]
            token[p], token[q], after[p] = new, -1, r
            put(q, inf)
            rank = None
            if r < n:
                before[r] = p
                rank = self.pairs.get(new << 20 | token[r])
            put(p, inf if rank is None else rank << bits | p)
            if o >= 0:
                rank = self.pairs.get(token[o] << 20 | new)
                put(o, inf if rank is None else rank << bits | o)
        return [t for t in token if t >= 0]

    def _learn(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Merge distinct new matches and file their ids and bytes; their slots."""
        new_ids, counts = [], np.zeros(len(sizes), np.int64)
        order, lower = [], 0
        for width in (1, 2, 4, 8, 16, 32, FOREST):
            rows = np.flatnonzero((sizes > lower) & (sizes <= width))
            lower = width
            for part in np.array_split(rows, max(1, len(rows) * width // CELLS)):
                if len(part):
                    ids, c = self.forest(data, starts[part], sizes[part], width)
                    new_ids.append(ids)
                    counts[part] = c
                    order.append(part)
        for row in np.flatnonzero(sizes > FOREST):
            ids = self.tree(data[starts[row]: starts[row] + sizes[row]].tobytes())
            new_ids.append(np.array(ids, np.int64))
            counts[row] = len(ids)
            order.append(np.array([row]))
        ids, order = np.concatenate(new_ids), np.concatenate(order)
        slots = self.slots + np.arange(len(order))
        self.slots += len(order)
        self.ids, self.store = _room(self.ids, self.used + len(ids)), _room(self.store, self.kept + int(sizes.sum()) + 8)
        self.begin, self.count, self.at, self.size = (_room(x, self.slots) for x in (self.begin, self.count, self.at, self.size))
        c = counts[order]
        self.begin[slots] = self.used + np.cumsum(c) - c
        self.count[slots] = c
        self.ids[self.used: self.used + len(ids)] = ids
        self.used += len(ids)
        n = sizes[order]
        self.at[slots] = at = self.kept + np.cumsum(n) - n
        self.size[slots] = n
        self.store[self.kept: self.kept + int(n.sum())] = data[np.repeat(starts[order] - at, n) + np.arange(self.kept, self.kept + int(n.sum()))]
        self.kept += int(n.sum())
        out = np.empty(len(sizes), np.int64)
        out[order] = slots
        return out

    def _learn_odd(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Slots of matches that a digest does not tell apart: these go by their bytes."""
        words = [data[a: a + n].tobytes() for a, n in zip(starts.tolist(), sizes.tolist())]
        new = {w: i for i, w in enumerate(words) if w not in self.odd}
        if new:
            rows = np.array(list(new.values()))
            self.odd.update(zip(new, self._learn(data, starts[rows], sizes[rows]).tolist()))
        return np.array([self.odd[w] for w in words], np.int64)

    def _grow_powers(self, n: int) -> None:
        def powers(of: int) -> np.ndarray:
            steps = np.full(1 << n.bit_length(), of, np.uint64)
            steps[0] = 1
            return np.multiply.accumulate(steps)

        odd = 0x9E3779B97F4A7C15
        self.powers, self.inverses = powers(odd), powers(pow(odd, -1, 1 << 64))

    def _slice(self, texts: list[str]) -> list[np.ndarray]:
        joined = "\0".join(texts) + "\0"
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        kinds = _classes()[cps]
        kinds[ends] = END
        starts = pretoken_starts(cps, kinds)
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        is_end = kinds[starts] == END
        b0 = starts if len(data) == len(cps) else np.flatnonzero((data & 0xC0) != 0x80)[starts]
        sizes = np.diff(np.append(b0, len(data)))
        # content hash of each match: mixed bytes times powers, taken back to the match's start
        if len(self.powers) <= len(data):
            self._grow_powers(len(data))
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.byte_mix[data] * self.powers[: len(data)], out=prefix[1:])
        h = (prefix[b0 + sizes] - prefix[b0]) * self.inverses[b0]
        h ^= h >> np.uint64(29)
        h = (h + sizes.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        words = np.flatnonzero(~is_end)
        out_counts = np.zeros(len(starts), np.int64)
        slot = np.zeros(len(words), np.int64)
        if len(words):
            uniq, first, inverse = np.unique(h[words], return_index=True, return_inverse=True)
            if self.slots + len(uniq) > CACHE or self.kept > CACHE_BYTES:
                self._clear()
            keys = uniq.tolist()
            find = self.known.get
            slots = np.array([find(k, -1) for k in keys], np.int64)
            fresh = np.flatnonzero(slots < 0)
            if len(fresh):
                rows = words[first[fresh]]
                slots[fresh] = self._learn(data, b0[rows], sizes[rows])
                self.known.update(zip((keys[i] for i in fresh.tolist()), slots[fresh].tolist()))
            slot = slots[inverse]
            # equal digests are no proof: every match is compared with the bytes that its slot stands for
            at, n = b0[words], sizes[words]
            odd = np.flatnonzero(differ(data, at, n, self.store, self.at[slot], self.size[slot]))
            if len(odd):
                slot[odd] = self._learn_odd(data, at[odd], n[odd])
        c = self.count[slot]
        out_counts[words] = c
        upto = np.cumsum(c)
        gather = np.repeat(self.begin[slot] - (upto - c), c) + np.arange(upto[-1] if len(upto) else 0)
        ids = self.ids[gather]
        stops = np.cumsum(out_counts)[np.flatnonzero(is_end)]
        return np.split(ids, stops[:-1])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """uint32 ids of each text, in order."""
        if not self.pairs:
            self._find_pairs()
        part, size = [], 0
        for t in texts:
            if part and size + len(t) > SLICE:
                yield from self._slice(part)
                part, size = [], 0
            part.append(t)
            size += len(t) + 1
        if part:
            yield from self._slice(part)

    def decode(self, ids: np.ndarray) -> bytes:
        sizes = self.token_sizes[ids]
        upto = np.cumsum(sizes)
        gather = np.repeat(self.token_starts[ids] - (upto - sizes), sizes) + np.arange(upto[-1] if len(upto) else 0)
        return self.token_bytes[gather].tobytes()


@lru_cache(2)
def load(path: str | None = None) -> Bpe:
    """The encoder of a worker; ``path`` defaults to the installed public vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(RANKS)
    return Bpe(path)


def _encoded(column: pa.Array, path: str | None) -> pa.Array:
    texts = [t or "" for t in column.to_pylist()]
    return pa.array([x.astype("<u4").tobytes() for x in load(path).encode(texts)], pa.binary())


def _decoded(column: pa.Array, path: str | None) -> pa.Array:
    bpe = load(path)
    return pa.array([bpe.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in column], pa.binary())


def _with(df: DataFrame, source: str, steps: list, path: str | None) -> DataFrame:
    """Add columns one after another (name, function), each computed from the one before."""
    added = [name for name, _ in steps]
    schema = StructType([f for f in df.schema.fields if f.name not in added] + [StructField(n, BinaryType()) for n in added])
    names = schema.names[: -len(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, source):
            made, column = [], part.column(source)
            for _, convert in steps:
                column = convert(column, path)
                made.append(column)
            yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + made, names + added)

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """Add ``ids``: the text's ids as little-endian unsigned 32-bit integers (null text: none)."""
    return _with(df, text, [(ids, _encoded)], path)


def decode(df: DataFrame, ids: str = "ids", data: str = "decoded", path: str | None = None) -> DataFrame:
    """Add ``data``: the bytes that the ids stand for (null ids: none)."""
    return _with(df, ids, [(data, _decoded)], path)


def round_trip(df: DataFrame, text: str = "text", ids: str = "ids", data: str = "decoded", path: str | None = None) -> DataFrame:
    """Both: ``ids`` of the text, then ``data`` decoded from those ids, in one pass of the workers."""
    return _with(df, text, [(ids, _encoded), (data, _decoded)], path)


def op1(spark, sf_dir: str) -> DataFrame:
    """Round trip of every document: token count and digests of the ids and of the decoded bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", whole_text().alias("text"))
    both = round_trip(docs).select("doc_id", "ids", "decoded")
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
