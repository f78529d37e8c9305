import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliant.operators import ordered as O


def test_equal_plain_windows(spark):
    rng, rows = random.Random(1), []
    for k in ["a", "b", None]:
        for o in sorted(rng.sample(range(200), 80)):
            rows.append((k, o, rng.choice([None, 1, 2, 3]), "x"))
    rows.append(("one", 7, None, "y"))
    df = spark.createDataFrame(rows, "k string, o int, v int, clash string")
    w = Window.partitionBy("k").orderBy("o")
    before, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "o", F.last("v", True).over(before).alias("a"), F.last("v", True).over(upto).alias("b"), F.sum(F.coalesce("v", F.lit(0))).over(upto).alias("s"), F.lag("o").over(w).alias("p"), F.lead("o").over(w).alias("n"))
    got = O.last_before(df, ["k"], "o", F.col("v"), "a", size=16)
    got = O.last_before(got, ["k"], "o", F.col("v"), "b", here=True, size=16)
    got = O.running_sum(got, ["k"], "o", F.col("v"), "s", size=16)
    got = O.neighbour(got, ["k"], "o", ["o"], "p", size=16)
    got = O.neighbour(got, ["k"], "o", ["o"], "n", after=True, size=16).select("k", "o", "a", "b", "s", F.col("p.o").alias("p"), F.col("n.o").alias("n"))
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert O.running_sum(df.limit(0), ["k"], "o", F.col("v"), "s").count() == 0
