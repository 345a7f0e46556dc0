"""Previous / next row of the same key without sending a whole key to one task.

A window ``partitionBy(key).orderBy(o)`` puts every row of a key into one task, so a key holding a
third of the data would sort a third of the data in one place.  ``neighbor`` splits each key into
order-range buckets:

1. ``lag``/``lead`` inside ``(key, bucket)`` -- bounded by one bucket's rows;
2. the edge row of every ``(key, bucket)`` by a map-side-combined aggregate (``max_by``/``min_by``);
3. ``lag``/``lead`` of those edges over ``partitionBy(key).orderBy(bucket)`` -- one row per
   non-empty bucket, so tiny;
4. rows without an in-bucket neighbour take the adjacent bucket's edge (a join on
   ``(key, bucket)`` that reuses step 1's partitioning).

The result equals the plain window for any bucket width.

With ``most`` the buckets themselves are kept small: the rows of every ``(key, bucket)`` are counted (a map-side
combined aggregate), and a bucket of more than ``most`` rows is cut at quantiles of the order column, read from a
sample of that bucket whose size follows its rows.  One visitor's hour of any size is then many small windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


#: Sampled order keys for every piece that a bucket is cut into.
SAMPLED = 32


def cut_heavy(b: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """``b`` with ``_nb_b`` = (bucket, piece): buckets over ``most`` rows are cut into pieces of about half of that.

    The heavy buckets and their cuts are broadcast: there are at most rows / most of the former, and twice that many
    cuts."""
    names = [*keys, "_nb_b"]
    at, ordkey = F.xxhash64(*order), F.struct(*[F.col(c) for c in order])

    def matched(left: DataFrame, small: DataFrame) -> DataFrame:
        small = small.select(*[F.col(c).alias(f"_nb_h{i}") for i, c in enumerate(names)], *[c for c in small.columns if c not in names])
        on = [F.col(c).eqNullSafe(F.col(f"_nb_h{i}")) for i, c in enumerate(names)]
        return left.join(F.broadcast(small), on, "left").drop(*[f"_nb_h{i}" for i in range(len(names))])

    heavy = cut_lineage(b.groupBy(*names).agg(F.count(F.lit(1)).alias("_nb_n")).where(F.col("_nb_n") > most))
    if heavy.isEmpty():
        return b
    heavy = heavy.withColumn("_nb_p", F.ceil(2 * F.col("_nb_n") / most))
    sample = matched(b, heavy).where(F.col("_nb_n").isNotNull() & (F.pmod(at, F.col("_nb_n")) < F.col("_nb_p") * SAMPLED))
    cuts = sample.groupBy(*names).agg(F.sort_array(F.collect_list(ordkey)).alias("s"), F.max("_nb_p").alias("p"))
    cuts = cut_lineage(cuts.select(*names, F.transform(
        F.sequence(F.lit(1), F.col("p") - 1), lambda i: F.get("s", F.floor(i * F.size("s") / F.col("p")).cast("int"))).alias("_nb_cuts")))
    piece = F.coalesce(F.size(F.filter("_nb_cuts", lambda c: c <= ordkey)), F.lit(0))
    return matched(b, cuts).withColumn("_nb_b", F.struct(F.col("_nb_b").alias("b"), piece.alias("p"))).drop("_nb_cuts")


def neighbor(df: DataFrame, keys: list[str], order: list[str], take: list[str], *, direction: str,
             bucket: Column, name: str, most: int | None = None) -> DataFrame:
    """Add struct column ``name`` holding ``take`` of the previous (``direction='prev'``) or next
    (``'next'``) row of the same ``keys`` in ``order``; NULL when there is none.

    ``order`` must be a total order within a key; ``bucket`` must be non-decreasing in ``order``
    (e.g. ``floor(order[0] / width)``).  ``most`` bounds the rows of a bucket (see above).
    """
    prev = direction == "prev"
    if direction not in ("prev", "next"):
        raise ValueError(direction)
    val = F.struct(*[F.col(c) for c in take])
    ordkey = F.struct(*[F.col(c) for c in order])
    b = df.withColumn("_nb_b", bucket)
    if most is not None:
        b = cut_heavy(b, keys, order, most)
    w_in = Window.partitionBy(*keys, "_nb_b").orderBy(*order)
    b = b.withColumn("_nb_in", F.lag(val).over(w_in) if prev else F.lead(val).over(w_in))
    edge = (F.max_by(val, ordkey) if prev else F.min_by(val, ordkey)).alias("_nb_edge")
    edges = b.groupBy(*keys, "_nb_b").agg(edge)
    w_b = Window.partitionBy(*keys).orderBy("_nb_b")
    adj = F.lag("_nb_edge").over(w_b) if prev else F.lead("_nb_edge").over(w_b)
    # a NULL key is a key like any other
    names = [*keys, "_nb_b"]
    edges = edges.select(*[F.col(c).alias(f"_nb_k{i}") for i, c in enumerate(names)], adj.alias("_nb_adj"))
    on = [F.col(c).eqNullSafe(F.col(f"_nb_k{i}")) for i, c in enumerate(names)]
    out = b.join(edges, on, "left")
    return (out.withColumn(name, F.coalesce("_nb_in", "_nb_adj"))
            .drop("_nb_in", "_nb_adj", "_nb_b", *[f"_nb_k{i}" for i in range(len(names))]))


def bucket_of(col: str, width: int) -> Column:
    return F.floor(F.col(col) / F.lit(width)).cast("bigint")


#: Right rows in all, and of one key, up to which ``asof`` broadcasts them.
FEW, FEW_OF_KEY = 100_000, 1_000


def _asof_few(left: DataFrame, right: DataFrame, keys: list[str], order: str, take: list[str], name: str) -> DataFrame:
    """``asof`` by the span of each right row, from its own place up to the next of its key: the spans are broadcast,
    and no left row is moved or read twice."""
    after = F.lead(order).over(Window.partitionBy(*keys).orderBy(order))
    spans = right.where(F.col(order).isNotNull()).select(*[F.col(c).alias(f"_nb_k{i}") for i, c in enumerate(keys)], F.col(order).alias("_nb_from"),
                                                         after.alias("_nb_to"), F.struct(*take).alias("_nb_r"))
    on = [F.col(c).eqNullSafe(F.col(f"_nb_k{i}")) for i, c in enumerate(keys)]
    on += [F.col(order) >= F.col("_nb_from"), F.col("_nb_to").isNull() | (F.col(order) < F.col("_nb_to"))]
    found = left.join(F.broadcast(spans), reduce(lambda x, y: x & y, on), "left")
    return found.select(*[F.col(f"`{c}`") for c in left.columns], F.col("_nb_r").alias(name))


def asof(left: DataFrame, right: DataFrame, keys: list[str], order: str, take: list[str], *, bucket: Column, name: str,
         most: int | None = None, few: int = FEW) -> DataFrame:
    """Add struct column ``name`` holding ``take`` of the latest ``right`` row of the same ``keys`` at or before each
    ``left`` row in ``order``; NULL when there is none.

    The neighbour search for two tables: both are put into order-range buckets of their key; inside a bucket the last
    right row so far, across buckets the last right row of the earlier ones (a window over one row per key and
    bucket).  So a key that holds a third of the left rows is many small windows.  Right rows of one key must differ
    in ``order``; ``bucket`` must be non-decreasing in it.

    Up to ``few`` right rows, at most ``FEW_OF_KEY`` of one key, are broadcast instead (``_asof_few``)."""
    if few:
        held = right.groupBy(*keys).count().agg(F.sum("count").alias("all"), F.max("count").alias("of_key")).first()
        if (held["all"] or 0) <= few and (held["of_key"] or 0) <= FEW_OF_KEY:
            return _asof_few(left, right, keys, order, take, name)
    mine, theirs = F.struct(*[F.col(f"`{c}`") for c in left.columns]), F.struct(*[F.col(c) for c in take])
    kinds = (left.select(mine.alias("x")).schema["x"].dataType, right.select(theirs.alias("x")).schema["x"].dataType)
    both = left.select(*keys, order, bucket.alias("_nb_b"), F.lit(1).alias("_side"), mine.alias("_l"), F.lit(None).cast(kinds[1]).alias("_r"))
    both = both.unionByName(right.select(*keys, order, bucket.alias("_nb_b"), F.lit(0).alias("_side"), F.lit(None).cast(kinds[0]).alias("_l"),
                                         theirs.alias("_r")))
    if most is not None:
        both = cut_heavy(both, keys, [order, "_side"], most)
    inside = Window.partitionBy(*keys, "_nb_b").orderBy(order, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_in", F.last("_r", ignorenulls=True).over(inside))
    edges = both.groupBy(*keys, "_nb_b").agg(F.max_by(F.col("_r"), F.when(F.col("_r").isNotNull(), F.col(order))).alias("_edge"))
    before = Window.partitionBy(*keys).orderBy("_nb_b").rowsBetween(Window.unboundedPreceding, -1)
    names = [*keys, "_nb_b"]
    edges = edges.select(*[F.col(c).alias(f"_nb_k{i}") for i, c in enumerate(names)], F.last("_edge", ignorenulls=True).over(before).alias("_before"))
    on = [F.col(c).eqNullSafe(F.col(f"_nb_k{i}")) for i, c in enumerate(names)]
    out = both.where("_side = 1").join(edges, on, "left")
    return out.select("_l.*", F.coalesce("_in", "_before").alias(name))
