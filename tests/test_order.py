"""Arrival keys of landed lines and topics, and neighbours in buckets of any size."""

import random

import pytest
from helpers import DAY, log_df, log_row
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.operators import logs, order, visitors
from marketlake.operators.neighbors import bucket_of, cut_heavy, neighbor
from marketlake.sources import readers
from marketlake.streaming import jobs


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    """Two files of 100,000 lines in all, larger than one split."""
    folder = tmp_path_factory.mktemp("landed")
    for name, lines in (("b.log", range(70_000)), ("a.log", range(70_000, 100_000))):
        (folder / name).write_text("".join(f"{i:06d} {'x' * 60}\n" for i in lines))
    return folder


def test_every_line_has_its_own_number_in_file_order(spark, landed):
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")      # some twenty splits
    try:
        rows = readers.source(spark, "text", str(landed)).select("value", "seq.*").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert len({(r.time, r.part, r.place, r.row) for r in rows}) == 100_000
    for name, first, n in (("b.log", 0, 70_000), ("a.log", 70_000, 30_000)):
        mine = sorted((r.place, int(r.value[:6])) for r in rows if r.part.endswith(name))
        assert mine == [(i, first + i) for i in range(n)]


def test_lines_of_a_stream_keep_their_order(spark, landed, tmp_path):
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        s = readers.source(spark, "text", str(landed), streaming=True, options={"maxFilesPerTrigger": 1})
        jobs.start_landing(s, str(tmp_path)).awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    got = spark.read.parquet(f"{tmp_path}/landed")
    assert got.select("batch").distinct().count() == 2
    for name, first, n in (("b.log", 0, 70_000), ("a.log", 70_000, 30_000)):
        mine = got.where(F.col("seq.part").endswith(name)).orderBy("seq").select("seq.place", "value").collect()
        assert [(r.place, int(r.value[:6])) for r in mine] == [(i, first + i) for i in range(n)]


def test_partitions_and_offsets_of_a_topic_do_not_collide(spark):
    places = [(7, p, o) for p in range(100) for o in (0, 1, 2**21, 2**21 + 1, 2**53)]
    random.Random(1).shuffle(places)
    df = spark.createDataFrame(places, "t long, p int, o long").withColumn(
        "seq", order.key(F.col("t"), order.partition_text(F.col("p")), F.col("o")))
    assert df.select("seq").distinct().count() == 500
    assert [(r.p, r.o) for r in df.orderBy("seq").collect()] == sorted((p, o) for _, p, o in places)


def test_text_of_a_key_has_its_order(spark):
    rnd = random.Random(5)
    keys = [(rnd.choice([1, 255, 256, 10**12]), rnd.choice(["f", "f/a", "f/ab", "é"]), rnd.choice([0, 15, 16, 2**40]), rnd.choice([0, 2**33])) for _ in range(200)]
    df = spark.createDataFrame([(k,) for k in set(keys)], f"seq {order.KEY.simpleString()}")
    df = df.withColumn("text", order.as_text(F.col("seq")))
    assert [tuple(r.seq) for r in df.orderBy("text").collect()] == [tuple(r.seq) for r in df.orderBy("seq").collect()]
    assert df.where(order.from_text(F.col("text")) != F.col("seq")).count() == 0


def test_visitor_rules_over_a_landed_file_equal_those_over_numbers(spark, tmp_path):
    """More lines than the old folded key could tell apart: repair and unique visits follow the lines."""
    rnd, base, rows = random.Random(3), 19675 * DAY, []
    for i in range(40_000):
        day = i // 9_000 + rnd.choice([0, 0, 0, 1])
        rows.append(log_row(i, f"m{rnd.randrange(12)}", base + day * DAY + rnd.randrange(DAY), last=rnd.choice([None, "home"]), is_new=rnd.choice("01")))
    batch = log_df(spark, rows).cache()
    text = batch.orderBy("seq").select(F.to_json(F.struct("common", "start", "page", "displays", "err", "ts")).alias("value"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "log.txt").write_text("".join(r.value + "\n" for r in text.collect()))
    landed = logs.parse_log(readers.source(spark, "text", str(tmp_path / "in")))

    def facts(df, seq):
        return sorted((r.s, r.mid, r.is_new, r.ts) for r in df.select(
            seq.alias("s"), F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts").collect())

    for rule in (visitors.repair_new_flag, lambda d: visitors.unique_visits(logs.split_page(d)),
                 lambda d: visitors.unique_visits(logs.split_page(d), most=500), lambda d: visitors.bounces(logs.split_page(d), "4 hours")):
        assert facts(rule(landed), F.col("seq.place")) == facts(rule(batch), F.col("seq"))


@pytest.mark.parametrize("direction", ["prev", "next"])
def test_heavy_buckets_are_cut_and_the_neighbours_stay(spark, direction):
    """One key holds a third of the rows in one bucket, a null key another: no window holds more than ``most`` rows."""
    rnd = random.Random(8)
    rows = [("hot", rnd.randrange(3_000_000), i) for i in range(20_000)] + [(None, rnd.randrange(9), 10**6 + i) for i in range(3_000)]
    rows += [(f"k{rnd.randrange(50)}", rnd.randrange(10**7), 10**7 + i) for i in range(40_000)]
    df = spark.createDataFrame(rows, "k string, o long, s long").repartition(6)
    got = neighbor(df, ["k"], ["o", "s"], ["s"], direction=direction, bucket=bucket_of("o", 3_600_000), name="n", most=1_000)
    w = Window.partitionBy("k").orderBy("o", "s")
    exp = df.withColumn("n", (F.lag if direction == "prev" else F.lead)(F.struct("s")).over(w))
    assert sorted((r.s, None if r.n is None else r.n.s) for r in got.collect()) == sorted((r.s, None if r.n is None else r.n.s) for r in exp.collect())
    cut = cut_heavy(df.withColumn("_nb_b", bucket_of("o", 3_600_000)), ["k"], ["o", "s"], 1_000)
    sizes = cut.groupBy("k", "_nb_b").count()
    assert sizes.agg(F.max("count")).first()[0] <= 1_000 and cut.count() == len(rows)


