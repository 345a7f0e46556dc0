"""Dimension lookups: left-outer enrichment with at most one match per key.

A lookup is a left join on one row per key.  Nothing here hints a broadcast: Catalyst broadcasts a
dimension only under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-decides from the actual
shuffle size, so a dimension that outgrows memory is joined by sort-merge instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(fact: DataFrame, dim: DataFrame, fact_key: str, columns: dict[str, str], *,
           dim_key: str = "id", overwrite: tuple[str, ...] = (), unique: bool = False) -> DataFrame:
    """Add ``columns`` (``{output name: dim column}``) looked up by ``fact[fact_key] = dim[dim_key]``.

    Rows without a match (or with a NULL key) pass with NULLs.  Output names listed in
    ``overwrite`` replace an existing fact column only where the key matched.  A key that the
    dimension repeats gives one match, its greatest row (a map-side-combined aggregate);
    ``unique=True`` states that the key is a primary key and skips that step.
    """
    tag = "_lk_" + fact_key
    d = dim.select(F.col(dim_key).alias(tag), *[F.col(src).alias(f"{tag}_{out}") for out, src in columns.items()])
    if not unique:
        rest = [c for c in d.columns if c != tag]
        d = d.where(F.col(tag).isNotNull()).groupBy(tag).agg(F.max(F.struct(*rest)).alias("_r")).select(tag, "_r.*")
    key = F.col(fact_key)
    if dict(fact.dtypes).get(fact_key) != dict(d.dtypes)[tag]:
        key = key.cast(dict(d.dtypes)[tag])
    j = fact.join(d, key == F.col(tag), "left")
    out = {}
    for name in columns:
        v = F.col(f"{tag}_{name}")
        if name in overwrite and name in fact.columns:
            v = F.when(F.col(tag).isNotNull(), v).otherwise(fact[name])
        out[name] = v
    keep = [c for c in fact.columns if c not in out]
    return j.select(*keep, *[v.alias(n) for n, v in out.items()])
