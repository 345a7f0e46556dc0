"""Exact top-k inner-product search, exhaustive and term at a time.

Components become integers, floor(256 x).  Candidates lie in blocks with, per component (term),
a postings list of (candidate, weight); a sparse query row scatters its weights times
the postings of its terms into a dense score array of the block, a partition keeps the block's best k
(ties to smaller ids), and the blocks' lists are merged.  Query rows and candidates
meet as pairs of bounded blocks, so no task holds more than one block of each.

A row is identified by vec_id: a query never returns rows of its own id, and exact repeats of a row
are one row.  Vectors that are null or hold null or non-finite components take no part; missing
trailing components count as zero; an all-zero query scores 0 everywhere.  Rows without a vec_id take
no part.  Scores are exact while they fit 64 bits.  Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship, table

K, EVERY, SCALE = 5, 50, 256
CANDIDATES, QUERIES = 8_192, 2_048


def integers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and ``w`` array<bigint>, only whole finite vectors, exact repeats once."""
    x = F.transform(column, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull()).where(fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, lambda v: F.floor(v * SCALE)).alias("w")).distinct())


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the earlier position (ids ascend)."""
    if len(scores) <= k:
        return np.lexsort((ids, -scores))
    limit = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > limit)
    tied = np.flatnonzero(scores == limit)[: k - len(above)]
    at = np.concatenate([above, tied])
    return at[np.lexsort((ids[at], -scores[at]))]


def _search(k: int):
    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                              "score": pd.Series(dtype="int64")})
        if queries.empty or block.empty:
            return empty
        block = block.sort_values("vec_id", kind="stable")
        ids = block["vec_id"].to_numpy()
        width = max(block["w"].map(len).max(), queries["w"].map(len).max())
        weights = np.ascontiguousarray(_matrix(block["w"], width).T)
        postings = []
        for row in weights:
            at = np.flatnonzero(row)
            postings.append((None, row) if len(at) == len(row) else (at, row[at]))   # None: every candidate
        found = []
        for q, vector in zip(queries["vec_id"].to_numpy(), _matrix(queries["w"], width)):
            scores = np.zeros(len(ids), np.int64)
            for term in np.flatnonzero(vector):
                at, weight = postings[term]
                if at is None:
                    scores += vector[term] * weight
                else:
                    scores[at] += vector[term] * weight
            lo, hi = np.searchsorted(ids, q), np.searchsorted(ids, q, "right")
            if lo < hi:
                others = np.concatenate([np.arange(lo), np.arange(hi, len(ids))])
                top = others[best(ids[others], scores[others], k)]
            else:
                top = best(ids, scores, k)
            found.append((np.full(len(top), q), ids[top], scores[top]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*found)))))

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score.  Both inputs: vec_id and ``w`` as ``integers`` gives them."""
    ship(vectors.sparkSession)
    n_blocks = max(1, -(-vectors.count() // CANDIDATES))
    n_groups = max(1, -(-queries.count() // QUERIES))
    # every (candidate block, query group) pair is one bounded task
    block = F.pmod(F.xxhash64("vec_id", "w"), F.lit(n_blocks)).cast("int")
    group = F.pmod(F.xxhash64("vec_id", "w"), F.lit(n_groups)).cast("int")
    left = queries.select("vec_id", "w", group.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("b"))
    right = vectors.select("vec_id", "w", block.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("g"))
    found = left.groupBy("b", "g").cogroup(right.groupBy("b", "g")).applyInPandas(
        _search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8(spark, sf_dir: str) -> DataFrame:
    vectors = materialize(integers(table(spark, sf_dir, "embeddings")))
    return search(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


ORACLE_SQL = f"""
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as w
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c as (select vec_id, unnest(w) as x, generate_subscripts(w, 1) as d from v),
s as (select q.vec_id as query_id, c.vec_id, cast(sum(q.x * c.x) as bigint) as score
  from c q join c on q.d = c.d and q.vec_id <> c.vec_id where q.vec_id % {EVERY} = 0 group by 1, 2),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= {K}"""
