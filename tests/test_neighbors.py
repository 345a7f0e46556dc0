import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.operators.neighbors import bucket_of, neighbor


@pytest.mark.parametrize("width,direction", [(1, "prev"), (5, "next"), (1000, "prev"), (13, "next")])
def test_bucketed_equals_plain_window(spark, width, direction):
    rnd = random.Random(width)
    data = [(f"k{rnd.randrange(3)}", i, rnd.randrange(100)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, o long, v long")
    got = neighbor(df, ["k"], ["o"], ["v", "o"], direction=direction, bucket=bucket_of("o", width), name="n")
    w = Window.partitionBy("k").orderBy("o")
    f = F.lag if direction == "prev" else F.lead
    exp = df.withColumn("n", f(F.struct("v", "o")).over(w))
    a = sorted((r.k, r.o, None if r.n is None else tuple(r.n)) for r in got.collect())
    b = sorted((r.k, r.o, None if r.n is None else tuple(r.n)) for r in exp.collect())
    assert a == b
