"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each text becomes a vector of transformed statistics.  The labelled rows give each class its
prior, mean and covariance through one map-side-combined aggregation over all of them (no sample);
a class covariance is shrunk towards the pooled one and towards its own diagonal.  Cholesky factors are computed once;
a score is the logistic of the difference of the two log densities and log priors.

Null text counts as empty and is scored like it.  Labels that are null, or whose row is missing, are
not learned from; a doc_id labelled twice counts twice.  Without rows of both classes every score is
the share of label 1 (0.5 without any).  Repeated rows and null ids are scored row by row.  Other
columns of the input travel inside one struct, so their names cannot clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import materialize, parts, ship, table

THRESHOLD = 0.3
#: Held out of learning: crc32(doc_id as text) mod FOLDS = 0.
FOLDS = 5
#: Shares of the pooled covariance and of the diagonal in a class covariance.
POOLED, DIAGONAL, RIDGE = 0.05, 0.05, 1e-3

_SYMBOL = re.compile(r"[#*$%&|<>]")
_MARK = re.compile(r"[!?]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"[0-9]")
_STOP = re.compile(r"[.,;:]")


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text."""
    words = text.split()
    n, chars = len(words), len(text)
    k, c = n + 5.0, chars + 25.0
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:])))
    same = sum(map(str.__eq__, words, words[1:]))
    lines = text.split("\n")
    log = math.log
    return [
        log(k),
        log((chars + 25.0) / k),
        log((len(_SYMBOL.findall(text)) + 0.3) / k),
        log((len(_MARK.findall(text)) + 0.3) / k),
        log((len(_UPPER.findall(text)) + 3.0) / c),
        log((len(_DIGIT.findall(text)) + 1.0) / c),
        log((len(_STOP.findall(text)) + 1.0) / k),
        log((distinct + 5.0) / k) / log(k),
        log((max(n - 1 - pairs, 0) + 0.5) / k),
        log((same + 0.3) / k),
        log((len(lines) - len(set(lines)) + 0.3) / (len(lines) + 1.0)),
    ]


SIZE = len(statistics(""))


def describe(docs: DataFrame, text: str = "text", column: str = "stats") -> DataFrame:
    """Add ``column``: the statistics of the whole text (array<double>)."""
    schema = StructType([f for f in docs.schema.fields if f.name not in (text, column)])
    names = schema.names
    out = docs.select(*[F.col(f"`{n}`") for n in names], F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "__text"):
            stats = [statistics(t or "") for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names]
                                             + [pa.array(stats, pa.list_(pa.float64()))], [*names, column])

    ship(docs.sparkSession)
    return out.mapInArrow(run, StructType([*schema.fields, StructField(column, ArrayType(DoubleType()))]))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))


class Qda:
    """Class means, cached Cholesky factors and the prior."""

    def __init__(self, sums: dict[int, tuple[int, np.ndarray, np.ndarray]]):
        total = sum(n for n, _, _ in sums.values())
        self.share = sums[1][0] / total if 1 in sums and total else (0.0 if total else 0.5)
        self.classes = None
        if any(k not in sums or sums[k][0] < 2 for k in (0, 1)):
            return
        own = {}
        for k, (n, s, ss) in sums.items():
            mean = s / n
            own[k] = (n, mean, ss / n - np.outer(mean, mean))
        pooled = sum(n * c for n, _, c in own.values()) / total
        self.classes = []
        for k in (0, 1):
            n, mean, cov = own[k]
            cov = (1 - POOLED) * cov + POOLED * pooled
            cov = (1 - DIAGONAL) * cov + DIAGONAL * np.diag(np.diag(cov)) + RIDGE * np.eye(SIZE)
            factor = np.linalg.cholesky(cov)
            self.classes.append((mean, np.linalg.inv(factor), math.log(n / total) - np.log(np.diag(factor)).sum()))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), self.share)
        logs = [const - 0.5 * np.square((x - mean) @ inverse.T).sum(axis=1) for mean, inverse, const in self.classes]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(described: DataFrame, labels: DataFrame) -> Qda:
    """Learn from every labelled row that is not held out."""
    train = (described.where(~held_out()).select("doc_id", "stats")
             .join(labels.select("doc_id", F.col("quality").alias("y")).where("y in (0, 1)"), "doc_id"))
    x = [F.col("stats")[i] for i in range(SIZE)]
    sums = [F.sum(c) for c in x] + [F.sum(x[i] * x[j]) for i in range(SIZE) for j in range(i + 1)]
    out = {}
    for row in train.groupBy("y").agg(F.count("*"), *sums).collect():   # one row per class
        ss = np.zeros((SIZE, SIZE))
        ss[np.tril_indices(SIZE)] = row[2 + SIZE:]
        ss = ss + np.tril(ss, -1).T
        out[row[0]] = (row[1], np.array(row[2: 2 + SIZE]), ss)
    return Qda(out)


def score(described: DataFrame, model: Qda) -> DataFrame:
    """Replace ``stats`` by ``score``."""
    names = [c for c in described.columns if c not in ("stats", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("stats").flatten().to_numpy().reshape(-1, SIZE)
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(model.score(x))],
                                             [*names, "score"])

    ship(described.sparkSession)
    schema = StructType([described.schema[n] for n in names] + [StructField("score", DoubleType())])
    return described.select(*names, "stats").mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``row`` (the whole input row as a struct), ``score`` and ``predicted``; texts are read twice,
    never shuffled, and described and scored in one pass of the workers."""
    model = fit(describe(docs.select("doc_id", "text")), labels)
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "row", "text"):
            x = [statistics(t or "") for t in batch.column("row").field("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.score(np.array(x)))], ["row", "score"])

    ship(docs.sparkSession)
    scored = carried.mapInArrow(run, StructType([carried.schema["row"], StructField("score", DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op7(spark, sf_dir: str) -> DataFrame:
    described = materialize(describe(table(spark, sf_dir, "documents").select("doc_id", "text")))
    scored = score(described, fit(described, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    return classify(docs, table(spark, sf_dir, "labels")).where("predicted = 1").select("row.*")
