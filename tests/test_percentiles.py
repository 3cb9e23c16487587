import math
import random

from pyspark.sql import functions as F

from tickforge.functions.percentiles import bucket, percentiles

SCHEMA = "k string, v double, w double"


def test_equals_the_built_in_percentile(spark):
    draw = random.Random(5)
    rows = [(draw.choice(["a", "b", None]), draw.choice([None, 0.0, -1.5, draw.uniform(-9, 9), draw.expovariate(0.001), 7.0]), draw.gauss(100, 1)) for _ in range(3000)]
    rows += [("one", 4.0, None), ("hot", 1.0, 1.0), ("nulls", None, None)] + [("hot", 3.0, 2.0)] * 2000
    df = spark.createDataFrame(rows, SCHEMA)
    wanted = {"low": ("v", 0.0), "mid": ("v", 0.5), "high": ("v", 0.99), "top": ("v", 1.0), "other": ("w", 0.95)}
    got = {r.k: tuple(r)[1:] for r in percentiles(df, ["k"], wanted).collect()}
    want = {r.k: tuple(r)[1:] for r in df.groupBy("k").agg(*[F.percentile(f, p).alias(n) for n, (f, p) in wanted.items()]).collect()}
    assert want.pop("nulls") == (None,) * 5 and got == want


def test_no_group_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, None)], SCHEMA)
    assert [tuple(r) for r in percentiles(df, [], {"m": ("v", 0.5)}).collect()] == [(1.5,)]
    assert percentiles(df.limit(0), ["k"], {"m": ("v", 0.5)}).count() == 0


def test_buckets_keep_the_order(spark):
    values = [-math.inf, -1e308, -2.0, -1.999, -1e-320, -0.0, 0.0, 1e-320, 0.5, 0.75, 1.0, 2.0, 1e308, math.inf, math.nan]
    got = [r.b for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got) and None not in got
