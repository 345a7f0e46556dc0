"""Importance resampling towards a target distribution, with hashed n-gram features.

Newlines separate words, so they cut texts into segments (lines).  Equal lines are folded by an aggregate,
each distinct line's features are counted once and multiplied by its occurrences; n-grams that reach over a
line end are counted from the texts by themselves (with single words there are none).  Both sides come down
to ``BUCKETS`` counts, whatever the corpus holds; those give one gain per bucket, and a document's weight is
the floored mean gain of its features, computed inside its row.  A draw without replacement is the top of
weight plus Gumbel noise, keyed by doc_id.  Ranks need no global sort: documents are counted per score (a
whole number, so their kinds are bounded by its range), a score's first rank is a running sum, and only the
drawn scores are ordered, each by itself.

Null text has no words.  Rows that repeat a doc_id are documents of their own with one noise; a null doc_id
draws as the empty id and comes before other ids.  Equal rows take ranks next to each other.  Without
target texts every gain follows the corpus alone.  An empty table gives no rows.  The result has only the
columns named here, so others cannot clash.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, parts, ship, table, whole_text

#: Words of lower-cased UTF-8: digits, a-z and everything that is not ASCII (fixed by the features' definition).
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LONGEST, BUCKETS, PERCENT, MIN_WORDS, SEED = 1, 10_000, 10, 20, 2024
#: Words whose bucket a worker remembers.
CACHE = 1 << 18


class Buckets(dict):
    """Feature -> bucket, remembered for a bounded number of features."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[feature] = found = zlib.crc32(feature) % self.buckets
        return found

    def of(self, words: list[bytes], longest: int) -> list[int]:
        """Buckets of all runs of 1 to ``longest`` consecutive words."""
        out = list(map(self.__getitem__, words))
        for k in range(2, longest + 1):
            out += [self[b" ".join(words[i:i + k])] for i in range(len(words) - k + 1)]
        return out

    def crossing(self, data: bytes, longest: int) -> list[int]:
        """Buckets of the runs whose first and last word stand in different lines."""
        lines = [WORD.findall(x) for x in data.lower().split(b"\n")]
        words, line = [w for x in lines for w in x], [i for i, x in enumerate(lines) for _ in x]
        return [self[b" ".join(words[i:i + k])] for k in range(2, longest + 1) for i in range(len(words) - k + 1)
                if line[i] != line[i + k - 1]]


def _texts(part: pa.RecordBatch) -> list[bytes]:
    return part.column("text").cast(pa.binary()).to_pylist()


def _count(texts: DataFrame, longest: int, buckets: int, crossing: bool) -> DataFrame:
    """bucket, n of rows (text, times): one partial count per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for part in parts(batches, "text"):
            found = [known.crossing(t, longest) if crossing else known.of(WORD.findall(t.lower()), longest) for t in _texts(part)]
            times = np.repeat(part.column("times").to_numpy(), [len(f) for f in found])
            total += np.bincount(np.fromiter(chain.from_iterable(found), np.int64), times, buckets).astype(np.int64)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["bucket", "n"])
    return texts.mapInArrow(run, "bucket int, n long")


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts by bucket; every distinct line is taken apart once."""
    ship(texts.sparkSession)
    t = whole_text(text)
    lines = texts.select(F.explode(F.split(t, "\n")).alias("text")).where("text <> ''").groupBy("text").agg(
        F.count("*").alias("times"))
    counted = _count(lines, longest, buckets, crossing=False)
    if longest > 1:
        counted = counted.union(_count(texts.select(t.alias("text"), F.lit(1).cast("long").alias("times")), longest, buckets, crossing=True))
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """floor(1000 * log ratio of the smoothed target and source shares) of each bucket, in doubles."""
    all_s, all_t = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return [math.floor(1000 * math.log((target.get(b, 0) + 1.0) * all_s / ((source.get(b, 0) + 1.0) * all_t)))
            for b in range(buckets)]


def score(docs: DataFrame, target: DataFrame, key: str = "doc_id", longest: int = LONGEST, buckets: int = BUCKETS,
          seed: int = SEED) -> DataFrame:
    """key, n_words, n_features, weight and score (weight plus noise) of every document."""
    side = [{r["bucket"]: r["n"] for r in bucket_counts(x, "text", longest, buckets).collect()} for x in (docs, target)]
    gain = np.array(gains(*side, buckets), np.int64)       # one number per bucket, whatever the corpus holds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(buckets)
        for part in parts(batches, "text"):
            words = [WORD.findall(t.lower()) for t in _texts(part)]
            found = [known.of(w, longest) for w in words]
            upto = np.cumsum([0, *map(len, found)])
            sums = np.concatenate([[0], np.cumsum(gain[np.fromiter(chain.from_iterable(found), np.int64, upto[-1])])])[upto]
            yield pa.RecordBatch.from_arrays([part.column(key), pa.array(list(map(len, words)), pa.int64()),
                                              pa.array(np.diff(upto)), pa.array(np.diff(sums))], [key, "n_words", "n_features", "s"])

    rows = docs.select(F.col(key).cast("long").alias(key), whole_text().alias("text")).mapInArrow(
        run, f"`{key}` long, n_words long, n_features long, s long")
    weight = F.expr("if(n_features = 0, 0L, (s - pmod(s, n_features)) div n_features)")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return rows.select(key, "n_words", "n_features", weight.alias("weight"), (weight + noise).alias("score"))


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", percent: int = PERCENT, min_words: int = MIN_WORDS,
             longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Every document with n_features, weight, score and rank (null: not drawn)."""
    spark = docs.sparkSession
    scored = materialize(score(docs, target, key, longest, buckets, seed))
    able = F.col("n_words") >= min_words
    kinds = sorted((tuple(r) for r in scored.where(able).groupBy("score").count().collect()), reverse=True)
    draw, before, taken = percent * sum(n for _, n in kinds) // 100, [], 0
    for value, n in kinds:
        if taken < draw:
            before.append((value, taken))
            taken += n
    lowest = before[-1][0] if before else 1 << 62
    starts = spark.createDataFrame(before, "score long, taken long")
    tie = Window.partitionBy("score").orderBy(F.asc_nulls_first(key), "weight", "n_features")
    top = scored.where(able & (F.col("score") >= lowest)).withColumn("place", F.row_number().over(tie)).join(starts, "score")
    rank = F.col("taken") + F.col("place")
    out = [key, "n_features", "weight", "score"]
    rest = scored.where(~(able & (F.col("score") >= lowest))).select(*out, F.lit(None).cast("long").alias("rank"))
    return top.select(*out, F.when(rank <= draw, rank).cast("long").alias("rank")).union(rest)


def op13(spark, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _oracle() -> str:
    texts = r"list_filter(string_split_regex(translate(coalesce(text, ''), '{}', '{}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    texts = texts.format("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return rf"""
with recursive bits as (select cast(v as bigint) as v, cast(v as bigint) as c, 0 as k from range(256) t(v)
  union all select v, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
step as (select list(c order by v) as s from bits where k = 8),
d as (select row_number() over () as r, doc_id, {texts} as w from documents),
b as (select {texts} as w from benchmark),
dw as (select r, unnest(w) as x from d), bw as (select unnest(w) as x from b),
vocab as (select distinct x from (select x from dw union all select x from bw)),
hexed as (select x, hex(encode(x)) as hx from vocab),
coded as (select x, xor(list_reduce(list_transform(range(0, len(hx) // 2), lambda i: cast('0x' || substr(hx, 2 * i + 1, 2) as bigint)),
      lambda c, y: xor(c >> 8, s[(xor(c, y) & 255) + 1]), 4294967295), 4294967295) % 10000 as bucket from hexed, step),
ds as (select bucket, count(*) as s from dw join coded using (x) group by bucket),
bt as (select bucket, count(*) as t from bw join coded using (x) group by bucket),
tot as (select (select count(*) from dw) as bs, (select count(*) from bw) as btot),
gain as (select bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1.0::double) * (bs + 10000.0::double)
      / ((coalesce(s, 0) + 1.0::double) * (btot + 10000.0::double)))) as bigint) as g
    from (select distinct bucket from coded) left join ds using (bucket) left join bt using (bucket), tot),
sums as (select r, sum(g) as g from dw join coded using (x) join gain using (bucket) group by r),
w as (select d.r, doc_id, cast(len(w) as bigint) as n_features,
      case when len(w) = 0 then 0 else cast(floor((g - ((g % len(w)) + len(w)) % len(w)) / len(w)) as bigint) end as weight,
      cast('0x' || substr(sha256('2024:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) as h
    from d left join sums using (r)),
sc as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296.0::double))) as bigint) as score from w),
n as (select 10 * count(*) // 100 as draw from sc where n_features >= 20),
rk as (select r, row_number() over (order by score desc, doc_id nulls first, weight, n_features) as k from sc where n_features >= 20)
select doc_id, n_features, cast(weight as bigint) as weight, cast(score as bigint) as score,
  case when k <= draw then cast(k as bigint) end as rank
from sc left join rk using (r), n"""


ORACLE_SQL = _oracle()
