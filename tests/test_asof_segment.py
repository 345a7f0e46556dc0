"""As-of search against a plain loop; segmentation against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from marketlake.functions.segment import segmented
from marketlake.operators import routing
from marketlake.operators.neighbors import asof, bucket_of


@pytest.mark.parametrize("width, most", [(1, None), (7, None), (10**6, 200)])
def test_asof_equals_a_loop(spark, width, most):
    rnd = random.Random(width)
    left = [(rnd.choice(["hot", "hot", "a", None]), rnd.randrange(4000), i) for i in range(3000)]
    right = list({(k, o): (k, o, f"r{n}") for n, (k, o) in enumerate((rnd.choice(["hot", "b", None]), rnd.randrange(4000)) for _ in range(60))}.values())
    got = asof(spark.createDataFrame(left, "k string, o long, id long"), spark.createDataFrame(right, "k string, o long, v string"),
               ["k"], "o", ["v", "o"], bucket=bucket_of("o", width), name="found", most=most)
    for r in got.collect():
        before = [x for x in right if x[0] == r.k and x[1] <= r.o]
        want = max(before, key=lambda x: x[1]) if before else None
        assert (r.found and (r.found.v, r.found.o)) == (want and (want[2], want[1]))
    assert got.count() == len(left)


def test_records_go_where_the_config_sent_them_when_they_came(spark):
    change = lambda seq, kind, sink: (seq, kind, {"source_table": "t", "operate_type": "insert", "sink_type": "kafka", "sink_table": sink})
    feed = spark.createDataFrame([change(10, "insert", "one"), change(20, "update", "two"), change(30, "delete", "two"), change(40, "insert", "three")],
                                 "seq long, type string, data map<string,string>")
    rows = [(s, "t", "bootstrap-insert" if s == 45 else "insert", {"id": str(s)}) for s in (5, 10, 19, 20, 35, 40, 45)] + [(50, "t", "update", {"id": "50"})]
    changes = spark.createDataFrame(rows, "seq long, table string, type string, data map<string,string>")
    routed = routing.filter_columns(routing.route_asof(changes, feed, normalize_bootstrap=True))
    assert sorted((r.seq, r.sink_table) for r in routed.collect()) == [(10, "one"), (19, "one"), (20, "two"), (40, "three"), (45, "three")]


def cut(run, known):
    out, pending, p = [], "", 0
    while p < len(run):
        n = max((n for n in range(1, len(run) - p + 1) if run[p:p + n] in known), default=0)
        if n:
            out += [pending] * bool(pending) + [run[p:p + n]]
            pending = ""
        else:
            pending += run[p]
        p += n or 1
    return out + [pending] * bool(pending)


def test_segmentation_equals_a_loop(spark):
    rnd = random.Random(2)
    known = ["红", "红色", "手机", "手机壳", "色手", "ab", "abc", "bcd", "x"]
    texts = ["".join(rnd.choice("红色手机壳abcdx") for _ in range(rnd.randrange(12))) + rnd.choice(["", " abcd", "-红色"]) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(500, None), (501, ""), (502, "!!")]
    got = segmented(spark.createDataFrame(rows, "id long, text string"), spark.createDataFrame([(w,) for w in [*known, "ABC", "", None]], "word string"))
    want = sorted((i, w) for i, t in enumerate(texts) for run in t.replace("-", " ").split() for w in cut(run, set(known)))
    assert sorted((r.id, r.keyword) for r in got.collect()) == want
    none = segmented(spark.createDataFrame(rows[:5], "id long, text string"), spark.createDataFrame([], "word string"))
    assert none.where(F.col("id") < 5).count() == sum(len(t.replace("-", " ").split()) for t in texts[:5])
