"""Detail layer of the behaviour log: parse, split, explode.

``parse_log`` / ``dirty_log`` split raw text into typed rows and malformed lines (a dead-letter
output instead of failing the job).  ``split_start`` / ``split_page`` / ``explode_displays`` are
three filters off one parsed input; in a streaming job they are written from one ``foreachBatch``
(see ``marketlake.streaming.jobs``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import ymd_from_millis
from pyspark.sql.types import ArrayType, DataType, DecimalType, IntegerType, LongType, StringType, StructField, StructType

from ..schemas import LOG


CORRUPT = "_corrupt_record"


NUMBERS = (LongType, IntegerType, DecimalType)


def _as_text(t: DataType) -> DataType:
    """The type with every number read as text first: producers quote some of them."""
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _as_text(f.dataType), True) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(_as_text(t.elementType))
    return StringType() if isinstance(t, NUMBERS) else t


def _typed(c: Column, t: DataType) -> Column:
    """Text read by ``_as_text`` in its declared type; what is no number becomes NULL, the row stays."""
    if _as_text(t) == t:
        return c
    if isinstance(t, StructType):
        return F.when(c.isNotNull(), F.struct(*[_typed(c[f.name], f.dataType).alias(f.name) for f in t.fields]))
    if isinstance(t, ArrayType):
        return F.transform(c, lambda x: _typed(x, t.elementType))
    return c.try_cast(t)


def parse_once(raw: DataFrame, value: str, schema: StructType) -> DataFrame:
    """``from_json`` evaluated exactly once per row, with a corrupt-record column.  Only text that
    is not a JSON object is corrupt; numbers may come quoted.

    Filters on parsed fields would otherwise be pushed below the projection, re-inlining the
    parse into every predicate (one JSON parse per referenced field).  ``inline`` of a one-element
    array is a generator, which predicates on its output cannot cross.  Malformed text lands in
    ``_corrupt_record`` (PERMISSIVE mode), so telling good from dirty rows needs no second parse.
    """
    carried = [c for c in raw.columns if c != value]
    full = StructType(_as_text(schema).fields + [StructField(CORRUPT, StringType(), True)])
    parsed = F.from_json(F.col(value), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    flat = raw.select(*carried, F.inline(F.array(parsed)))
    return flat.select(*carried, *[_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields], CORRUPT)


def parse_log(raw: DataFrame, value: str = "value") -> DataFrame:
    """Raw JSON lines -> typed log rows (``common, start, page, displays, err, ts`` + carried cols)."""
    return parse_once(raw, value, LOG).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def dirty_log(raw: DataFrame, value: str = "value") -> DataFrame:
    """Lines that are not a JSON object of the log schema (the dead-letter output)."""
    p = parse_once(raw, value, LOG)
    return p.filter(F.col(CORRUPT).isNotNull()).select(*[c for c in raw.columns if c != value],
                                                        F.col(CORRUPT).alias(value))


def is_start(df: DataFrame | None = None) -> Column:
    return F.coalesce(F.size(F.col("start")), F.lit(-1)) > 0


def split_start(log: DataFrame) -> DataFrame:
    """App-start logs: ``start`` present and non-empty."""
    return log.filter(is_start())


def split_page(log: DataFrame) -> DataFrame:
    """Page logs: everything that is not a start log (displays stay on the row, without page_id)."""
    return log.filter(~is_start())


def explode_displays(log: DataFrame, carry: tuple[str, ...] = ("seq",)) -> DataFrame:
    """One row per display of a page log: the display's fields + the page's ``page_id``.

    Inner explode: a page without displays gives no row.  ``ts`` and ``common`` are not part of
    the display output; ``carry`` names extra top-level columns to keep (default: the arrival seq).
    """
    pages = split_page(log)
    carried = [c for c in carry if c in log.columns]
    return (pages.select(*carried, F.col("page.page_id").alias("page_id"), F.explode("displays").alias("_d"))
            .select(*carried, "_d.*", "page_id"))


def is_entry() -> Column:
    """Entry page: no previous page id (NULL or empty)."""
    return F.coalesce(F.col("page.last_page_id"), F.lit("")) == ""


def with_day(log: DataFrame, name: str = "dt") -> DataFrame:
    return log.withColumn(name, ymd_from_millis(F.col("ts")))


def session_entries(page_log: DataFrame) -> DataFrame:
    """Entry pages of the page log (the session-start predicate used by UV, bounce and sv)."""
    return page_log.filter(is_entry())
