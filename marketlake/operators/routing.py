"""Change-record layer: clean, route by configuration, filter columns, merge dimension upserts.

* ``clean_changes``: keep records with a table and a non-empty ``data`` object.
* ``route``: inner join with the routing config on ``(table, type) = (source_table, operate_type)``
  (one config row per key, broadcast: there are about as many keys as tables, and a shuffle by them would send all
  records of a table to one task); ``facts`` / ``dims`` are its ``kafka`` / ``hbase`` rows, other sink types go nowhere, ``unmatched`` is the
  anti-join.  ``bootstrap-insert`` counts as ``insert`` when ``normalize_bootstrap``.
* ``route_asof``: the same under the config history, as it stood when each record arrived.
* ``filter_columns``: keep only the keys listed in ``sink_columns`` (exact, comma-separated, no
  trimming).
* ``latest_config``: current config from a config change feed (latest row per key; deletes drop
  the key).
* ``merge_dimension``: column-level last-writer-wins upsert of change maps into a snapshot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CHANGE, SINK_HBASE, SINK_KAFKA
from .logs import CORRUPT, parse_once
from .neighbors import asof
from .order import bucket


def parse_changes(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON text -> ``database, table, type, data, ts`` (+ carried columns), parsed once per row;
    malformed records are dropped (the dead letters are ``dirty_changes``)."""
    return parse_once(raw, value, CHANGE).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def dirty_changes(raw: DataFrame, value: str = "value") -> DataFrame:
    return parse_once(raw, value, CHANGE).filter(F.col(CORRUPT).isNotNull())


def clean_changes(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("table").isNotNull() & F.col("data").isNotNull() & (F.size("data") > 0))


def _type(normalize_bootstrap: bool):
    t = F.col("type")
    return F.when(t == "bootstrap-insert", F.lit("insert")).otherwise(t) if normalize_bootstrap else t


CONFIG_KEY = ["source_table", "operate_type"]
CONFIG_COLUMNS = ["sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend"]


def current_config(config: DataFrame) -> DataFrame:
    """One row per (source_table, operate_type): the latest by ``seq`` where the config has one, else
    the greatest."""
    row = F.struct(*[c for c in CONFIG_COLUMNS if c in config.columns])
    pick = F.max_by(row, "seq") if "seq" in config.columns else F.max(row)
    return config.groupBy(*CONFIG_KEY).agg(pick.alias("_c")).select(*CONFIG_KEY, "_c.*")


def route(changes: DataFrame, config: DataFrame, normalize_bootstrap: bool = False) -> DataFrame:
    """Matched records with their config columns (``sink_type, sink_table, sink_columns, sink_pk``)."""
    # the column list is split once per config row, not once per record and key
    cfg = current_config(config).withColumn("_keep", F.split("sink_columns", ","))
    c = changes.withColumn("type", _type(normalize_bootstrap))
    return c.join(F.broadcast(cfg), (F.col("table") == F.col("source_table")) & (F.col("type") == F.col("operate_type")), "inner")


#: Change positions of one (table, type) that a bucket of the as-of search spans, and rows of one window.
CONFIG_BUCKET, MOST_ROWS = 1 << 20, 1_000_000


def route_asof(changes: DataFrame, config_feed: DataFrame, normalize_bootstrap: bool = False) -> DataFrame:
    """Matched records under the config as it stood when they arrived: for each record the latest row of the config
    feed ``(seq, type, data)`` for its ``(table, type)`` at or before it; none, or a ``delete``, routes it nowhere.

    ``route`` takes the current config for all records; here a later change leaves earlier records where they went."""
    row = F.col("data")
    history = config_feed.select("seq", row["source_table"].alias("table"), row["operate_type"].alias("type"),
                                 F.col("type").alias("_change"), *[row[c].alias(c) for c in CONFIG_COLUMNS])
    c = changes.withColumn("type", _type(normalize_bootstrap))
    found = asof(c, history, ["table", "type"], "seq", ["_change", *CONFIG_COLUMNS], name="_c", most=MOST_ROWS,
                 bucket=bucket(changes, "seq", CONFIG_BUCKET))
    found = found.where("_c is not null and _c._change <> 'delete'")
    out = found.select(*c.columns, F.col("table").alias("source_table"), F.col("type").alias("operate_type"),
                       *[F.col(f"_c.{x}").alias(x) for x in CONFIG_COLUMNS])
    return out.withColumn("_keep", F.split("sink_columns", ","))


def unmatched(changes: DataFrame, config: DataFrame, normalize_bootstrap: bool = False) -> DataFrame:
    cfg = config.select(*CONFIG_KEY).distinct()
    c = changes.withColumn("type", _type(normalize_bootstrap))
    return c.join(F.broadcast(cfg), (F.col("table") == F.col("source_table")) & (F.col("type") == F.col("operate_type")), "left_anti")


def filter_columns(routed: DataFrame) -> DataFrame:
    """``data`` reduced to the configured columns; NULL/empty ``sink_columns`` keeps all."""
    keep = F.col("_keep") if "_keep" in routed.columns else F.split(F.col("sink_columns"), ",")
    filtered = F.map_filter("data", lambda k, v: F.array_contains(keep, k))
    all_cols = F.col("sink_columns").isNull() | (F.col("sink_columns") == "")
    out = routed.withColumn("data", F.when(all_cols, F.col("data")).otherwise(filtered))
    return out.drop("_keep")


def facts(routed: DataFrame) -> DataFrame:
    return filter_columns(routed.filter(F.col("sink_type") == SINK_KAFKA))


def kept(routed: DataFrame) -> DataFrame:
    """Facts and dimension rows in one pass over the routed records."""
    return filter_columns(routed.filter(F.col("sink_type").isin(SINK_KAFKA, SINK_HBASE)))


def dims(routed: DataFrame) -> DataFrame:
    return filter_columns(routed.filter(F.col("sink_type") == SINK_HBASE))


def latest_config(config_changes: DataFrame) -> DataFrame:
    """Config change feed ``(seq, type, data map)`` -> current ``table_process`` rows.

    Latest change per ``(source_table, operate_type)`` by ``seq``; a ``delete`` removes the key.
    """
    d = config_changes.select(
        "seq", "type", F.col("data")["source_table"].alias("source_table"),
        F.col("data")["operate_type"].alias("operate_type"), "data")
    last = (d.groupBy("source_table", "operate_type")
            .agg(F.max_by(F.struct("type", "data"), "seq").alias("_l")))
    last = last.filter(F.col("_l.type") != "delete")
    cols = ["sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend"]
    return last.select("source_table", "operate_type", *[F.col("_l.data")[c].alias(c) for c in cols])


#: Change types that write dimension columns (deletes are not applied).
APPLIED = ("insert", "update", "bootstrap-insert")


def key_text(key: str | list[str], data: str = "data") -> Column:
    """Canonical text of a row's key: the value of one key column, a JSON array of several; NULL if one is missing."""
    names = [key] if isinstance(key, str) else list(key)
    values = [F.col(data)[n] for n in names]
    if len(values) == 1:
        return values[0]
    known = reduce(lambda x, y: x & y, [v.isNotNull() for v in values])
    return F.when(known, F.to_json(F.array(*values)))


def merge_dimension(snapshot: DataFrame, changes: DataFrame, key: str | list[str] = "id",
                    apply_types: tuple[str, ...] = APPLIED) -> DataFrame:
    """New snapshot ``(id, data MAP<STRING,STRING>)`` from ``snapshot (id, data)`` and change rows
    ``(seq, type, data)`` of one dimension; ``id`` is ``key_text`` of the key columns.

    Every column takes its latest written value (by ``seq``), so two updates of different columns
    in one batch both land; a column absent from all changes keeps the snapshot value; deletes are
    not applied; a change without its key has no row.  Work is one aggregate by ``(id, column)`` and one by
    ``id`` (map-side combined) plus a full outer join on ``id``.
    """
    ch = changes.filter(F.col("type").isin(*apply_types)).withColumn("_id", key_text(key)).where("_id is not null")
    cells = ch.select("_id", "seq", F.explode("data").alias("k", "v"))
    latest = cells.groupBy("_id", "k").agg(F.max_by("v", "seq").alias("v"))
    upd = latest.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("_new"))
    old = snapshot.select(F.col("id").cast("string").alias("_id"), F.col("data").alias("_old"))
    j = old.join(upd, "_id", "full_outer")
    merged = F.map_zip_with(F.coalesce("_old", F.create_map().cast("map<string,string>")),
                            F.coalesce("_new", F.create_map().cast("map<string,string>")),
                            lambda k, v1, v2: F.when(F.map_contains_key(F.col("_new"), k), v2).otherwise(v1))
    return j.select(F.col("_id").alias("id"), merged.alias("data"))
