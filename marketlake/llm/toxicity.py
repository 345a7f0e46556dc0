"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word is the bag of its character n-grams (3 to 6, with word edges, hashed to a fixed number of
buckets); its vector is the mean of their embeddings, so a misspelling shares most of the vectors of
the word it distorts.  A window's vector is the mean of its words' and the softmax layer scores it; a
document's score is that of its worst window, so one insult is not diluted by a long text.

Embeddings and softmax are trained jointly in numpy: first on whole-document means, then on each
document's worst window under the current model.  Fitting takes at most ``SAMPLE`` labelled rows and
``SAMPLE_BYTES`` bytes of their texts (documented bounds; rows spread by a hash of doc_id, with each class
allowed half of them); a part of them calibrates the score.  Scoring reads every whole text once.

Null text, and text without letters, has no window and gets the score of an empty bag.  Null
labels are not learned from.  Without rows of both classes every score is the share of label 1 (0
without any).  Repeated rows and null ids are scored row by row; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts, ship, table, whole_text

THRESHOLD = 0.7
#: Held out of learning: crc32(doc_id as text) mod FOLDS = HELD.
FOLDS, HELD = 3, 1
#: Most labelled rows to learn from, and most bytes of their texts.
SAMPLE, SAMPLE_BYTES = 6_000, 24 << 20
BUCKETS, SIZE, GRAMS = 1 << 17, 8, 6
WINDOW = 3
START, WINDOW_STEPS, RATE, FLOOR, DECAY = 0.1, 40, 0.05, 0.05, 1e-3
SLICE = 500_000

_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD, F.lit(False))


@lru_cache(1)
def _letter() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    for m in re.finditer(r"[^\W\d_]+", "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)):
        table[[ord(c) for c in m.group()]] = True
    return table


def grams(lowered: str) -> tuple[np.ndarray, np.ndarray, int]:
    """(bucket of each n-gram, the word it belongs to, number of words) of a lower-cased text.

    Words are runs of letters with one edge mark between them; an n-gram may have an edge at either
    end but none inside."""
    cps = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter()[cps]
    marked = np.concatenate([[0], np.where(letter, cps, 0), [0]]).astype(np.uint32)
    keep = np.ones(len(marked), bool)
    keep[1:] = (marked[1:] > 0) | (marked[:-1] > 0)
    a = marked[keep]
    if len(a) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), 0
    edge = a == 0
    word = np.cumsum(edge) - 1      # of a letter: how many edges lie before it, less one
    ids, owner = [], []
    h = a[:-1] * np.uint32(0x9E3779B1) + a[1:]
    clean = ~edge[1:-1]
    for k in range(3, GRAMS + 1):
        n = len(a) - k + 1
        if n <= 0:
            break
        h = (h[:n] ^ (h[:n] >> np.uint32(15))) * np.uint32(0x85EBCA77) + a[k - 1:]
        if k > 3:
            clean = clean[:n] & ~edge[k - 2: k - 2 + n]
        at = np.flatnonzero(clean)
        g = h[at] * np.uint32(0xC2B2AE3D)
        ids.append(((g ^ (g >> np.uint32(16))) % np.uint32(BUCKETS)).astype(np.int64))
        owner.append(word[at + 1])
    return np.concatenate(ids), np.concatenate(owner), int(edge.sum()) - 1


def worst(values: np.ndarray) -> tuple[float, int]:
    """Highest mean over windows of WINDOW words and where that window begins."""
    n = len(values)
    if n == 0:
        return 0.0, 0
    if n <= WINDOW:
        return values.sum() / WINDOW, 0
    total = np.concatenate([[0.0], np.cumsum(values)])
    means = total[WINDOW:] - total[:-WINDOW]
    at = int(means.argmax())
    return means[at] / WINDOW, at


class Model:
    """What scoring needs: one number per bucket (embedding times softmax difference), slope, bias."""

    def __init__(self, buckets: np.ndarray, slope: float, bias: float):
        self.buckets, self.slope, self.bias = buckets, slope, bias

    def raw(self, texts: list[str]) -> np.ndarray:
        """Worst-window value of each text; short texts go through numpy together."""
        out, part, size = np.zeros(len(texts)), [], 0
        for i, t in enumerate(texts):
            part.append(i)
            size += len(t)
            if size > SLICE or i == len(texts) - 1:
                lowered = [texts[j].lower() for j in part]
                ids, owner, n = grams("\n".join(lowered))
                values = np.bincount(owner, self.buckets[ids], n) / np.maximum(np.bincount(owner, minlength=n), 1)
                cps = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
                letter = _letter()[cps]
                begins = letter.copy()
                begins[1:] &= ~letter[:-1]
                upto = np.concatenate([[0], np.cumsum(begins)])
                ends = np.cumsum([len(x) + 1 for x in lowered]) - 1
                lo = 0
                for j, stop in zip(part, upto[np.minimum(ends, len(cps))]):
                    out[j] = worst(values[lo:stop])[0]
                    lo = stop
                part, size = [], 0
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(texts) + self.bias, -500, 500)))


class Bags:
    """Labelled texts as word numbers: a text is dropped as soon as it is read."""

    def __init__(self):
        self.vocabulary: dict[str, int] = {}
        self.docs: list[np.ndarray] = []
        self.labels: list[int] = []

    def add(self, text: str, label: int) -> None:
        known = self.vocabulary
        self.docs.append(np.array([known.setdefault(w, len(known)) for w in words(text)], np.int32))
        self.labels.append(label)

    def train(self, seed: int = 4) -> Model:
        return _train(self.vocabulary, self.docs, np.array(self.labels, np.int64), seed)


def train(texts: list[str], y: np.ndarray, seed: int = 4) -> Model:
    """Joint training of embeddings and softmax on labelled texts."""
    bags = Bags()
    for t, label in zip(texts, y.tolist()):
        bags.add(t, label)
    return bags.train(seed)


def _train(vocabulary: dict[str, int], docs: list[np.ndarray], y: np.ndarray, seed: int) -> Model:
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(BUCKETS), 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    rng = np.random.default_rng(seed)
    flat, owner, n_words = grams(" ".join(vocabulary))
    order = np.argsort(owner, kind="stable")
    flat, owner = flat[order], owner[order]
    sizes = np.bincount(owner, minlength=n_words)
    begins = np.cumsum(sizes) - sizes
    fitted = rng.random(len(docs)) < 0.75
    learn = np.flatnonzero(fitted)
    e = rng.normal(0, 0.01, (BUCKETS, SIZE))
    w = rng.normal(0, 0.5, (SIZE, 2))
    b = np.zeros(2)
    positive = min(max(y[learn].mean(), 1e-3), 1 - 1e-3)
    weight = np.where(y == 1, 1 / positive, 1 / (1 - positive))
    weight = weight / weight[learn].sum()

    def gradients(rows: np.ndarray, which: np.ndarray, shares: np.ndarray):
        """Gradients of the weighted log loss; which/shares: (document, word) weights of each bag."""
        used, inverse = np.unique(rows, return_inverse=True)
        c = sizes[used]
        ends = np.cumsum(c)
        ids = flat[np.repeat(begins[used] - (ends - c), c) + np.arange(ends[-1])]
        bag = np.zeros((len(docs), SIZE))
        for k in range(SIZE):
            vector = np.add.reduceat(e[ids, k], ends - c) / c
            bag[:, k] = np.bincount(which, shares * vector[inverse], len(docs))
        logits = bag[learn] @ w + b
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(learn)), y[learn]] -= 1
        p *= weight[learn][:, None]
        back = np.zeros((len(docs), SIZE))
        back[learn] = p @ w.T
        grad_e = np.zeros_like(e)
        for k in range(SIZE):
            per_word = np.bincount(inverse, shares * back[which, k], len(used)) / c
            grad_e[:, k] = np.bincount(ids, np.repeat(per_word, c), BUCKETS)
        return grad_e, bag[learn].T @ p, p.sum(axis=0)

    whole = [i for i in learn if len(docs[i])]
    # whole documents: one gradient step on their distinct words, each n-gram's gradient divided by
    # its spread over documents, so it moves as far as the classes differ on it
    distinct = [np.unique(docs[i]) for i in whole]
    pull = np.where(y == 1, 1 / positive, -1 / (1 - positive)) / len(learn)
    rows = np.concatenate(distinct)
    pulls = np.repeat(pull[whole], [len(d) for d in distinct])
    first = np.bincount(flat, np.repeat(np.bincount(rows, pulls, n_words), sizes), BUCKETS)
    second = np.bincount(flat, np.repeat(np.bincount(rows, pulls * pulls, n_words), sizes), BUCKETS)
    floor = 4 * (pull ** 2).max()
    slope_w = w[:, 1] - w[:, 0]
    e += START * (first / np.sqrt(second + floor))[:, None] * slope_w / (slope_w @ slope_w)

    def per_word() -> np.ndarray:
        return np.add.reduceat((e @ (w[:, 1] - w[:, 0]))[flat], begins) / sizes

    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (e, w, b)]
    for t in range(1, WINDOW_STEPS + 1):
        values = per_word()
        picked = []
        for i in whole:
            at = worst(values[docs[i]])[1]
            picked.append(docs[i][at: at + WINDOW])
        lengths = [len(x) for x in picked]
        got = gradients(np.concatenate(picked), np.repeat(whole, lengths), np.full(sum(lengths), 1 / WINDOW))
        for x, g, m in zip((e, w, b), got, moments):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            scale = np.sqrt(m[1] / (1 - 0.99 ** t))
            # the floor keeps n-grams that few documents share from moving as far as common ones
            x -= RATE * (m[0] / (1 - 0.9 ** t)) / (scale + FLOOR * scale.max() + 1e-12)
            x *= 1 - DECAY
    values = per_word()
    raw = np.array([worst(values[d])[0] for d in docs])
    x, target = raw[~fitted], y[~fitted].astype(float)
    if not len(x) or target.min() == target.max():
        x, target = raw, y.astype(float)
    slope, bias = 1.0, float(b[1] - b[0])
    for _ in range(200):   # Newton steps of a one-variable logistic fit, lightly held near its start
        p = 1 / (1 + np.exp(-np.clip(slope * x + bias, -30, 30)))
        g = np.array([((p - target) * x).sum() + 0.01 * (slope - 1), (p - target).sum()])
        v = p * (1 - p) + 1e-6
        h = np.array([[(v * x * x).sum() + 0.01, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-3]])
        move = np.linalg.solve(h, g)
        move *= min(1.0, 1.0 / max(1e-9, np.abs(move).max()))
        slope, bias = slope - move[0], bias - move[1]
        if np.abs(move).max() < 1e-6:
            break
    return Model(e @ (w[:, 1] - w[:, 0]), float(slope), float(bias))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on a hash-spread sample of at most SAMPLE labelled rows that are not held out."""
    marked = labels.select("doc_id", F.col("toxic").alias("y")).where("y in (0, 1)").where(~held_out())
    # choose the sample among the labels, then fetch only its texts
    spread = F.xxhash64("doc_id", "y")
    chosen = marked.where("y = 1").orderBy(spread).limit(SAMPLE // 2).unionAll(
        marked.where("y = 0").orderBy(spread).limit(SAMPLE // 2))
    texts = docs.select("doc_id", whole_text().alias("t")).join(F.broadcast(chosen), "doc_id").select(
        "t", "y", F.octet_length("t").alias("size"), F.xxhash64("doc_id", "t").alias("at"))
    sized = texts.select("at", "y", "size").distinct().orderBy("at", "y").limit(SAMPLE).collect()
    taken, room = [], SAMPLE_BYTES
    for r in sized:                  # in the order of a hash; a text that no longer fits is left out whole
        if r["size"] <= room:
            taken.append((r["at"], r["y"]))
            room -= r["size"]
    bag = Bags()
    if taken:
        few = F.broadcast(docs.sparkSession.createDataFrame(taken, "at long, y int"))
        for r in texts.dropDuplicates(["at", "y"]).join(few, ["at", "y"]).orderBy("at", "y").toLocalIterator():
            bag.add(r["t"], r["y"])
    total = marked.agg(F.avg("y")).first()[0]
    model = bag.train()
    if taken and 0 < total < 1:   # the sample may hold more of the rare class: put its prior back
        share = sum(y for _, y in taken) / len(taken)
        if 0 < share < 1 and model.slope:
            model.bias += float(np.log(total / (1 - total)) - np.log(share / (1 - share)))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``score`` of each whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text"):
            scores = model.score([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op4(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
