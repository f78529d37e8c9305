"""Ordered operations over keys of any size.

A window over a key needs all of the key's rows in one task. Here a key's rows are cut
into runs of ``size`` successive ordinals: windows stand over runs, and what one run hands
to the next is carried in a table of one row per run. Rows of a key must have distinct,
non-null, non-negative integer ordinals (gaps do no harm: an empty run costs nothing).
Null keys are a key of their own. Columns that begin with ``_`` are used inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIZE = 4096


def _cut(df: DataFrame, ord_: str, size: int) -> DataFrame:
    return df.withColumn("_run", F.floor(F.col(ord_) / size))


def _back(df: DataFrame, small: DataFrame, key: list[str]) -> DataFrame:
    """``df`` with the columns of ``small`` (one row per key and run); null keys meet."""
    on = [df[k].eqNullSafe(small[f"_k{i}"]) for i, k in enumerate(key)] + [df["_run"] == small["_r"]]
    return df.join(small, on, "left").drop(*[f"_k{i}" for i in range(len(key))], "_r")


def _renamed(small: DataFrame, key: list[str], *cols: str) -> DataFrame:
    return small.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.col("_run").alias("_r"), *cols)


def last_of(df: DataFrame, key: list[str], ord_: str, values: dict[str, Column], here: bool = False, size: int = SIZE) -> DataFrame:
    """``df`` with a column per name: the last non-null value of the key's earlier rows (with
    ``here`` the row's own counts too); null where there is none. One pass for all of them."""
    names = list(values)
    d = _cut(df.select("*", *[v.alias(f"_v{i}") for i, v in enumerate(values.values())]), ord_, size)
    held = [F.when(F.col(f"_v{i}").isNotNull(), F.struct(F.col(f"_v{i}").alias("v"))) for i in range(len(names))]
    tails = d.groupBy(*key, "_run").agg(*[F.max_by(h, F.when(h.isNotNull(), F.col(ord_))).alias(f"_t{i}") for i, h in enumerate(held)])
    w = Window.partitionBy(*key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    tails = tails.select(*key, "_run", *[F.last(f"_t{i}", ignorenulls=True).over(w).alias(f"_c{i}") for i in range(len(names))])
    inner = Window.partitionBy(*key, "_run").orderBy(ord_).rowsBetween(Window.unboundedPreceding, 0 if here else -1)
    d = d.select("*", *[F.last(f"_v{i}", ignorenulls=True).over(inner).alias(f"_i{i}") for i in range(len(names))])
    d = _back(d, _renamed(tails, key, *[f"_c{i}" for i in range(len(names))]), key)
    keep = [F.col(f"`{c}`") for c in df.columns if c not in values]
    return d.select(*keep, *[F.coalesce(f"_i{i}", F.col(f"_c{i}.v")).alias(n) for i, n in enumerate(names)])


def last_before(df: DataFrame, key: list[str], ord_: str, value: Column, name: str, here: bool = False, size: int = SIZE) -> DataFrame:
    """``last_of`` one value."""
    return last_of(df, key, ord_, {name: value}, here, size)


def running_sum(df: DataFrame, key: list[str], ord_: str, value: Column, name: str, size: int = SIZE) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` up to and with the row (nulls count 0)."""
    d = _cut(df.withColumn("_v", F.coalesce(value, F.lit(0))), ord_, size)
    w = Window.partitionBy(*key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    sums = d.groupBy(*key, "_run").agg(F.sum("_v").alias("_s")).withColumn("_b", F.coalesce(F.sum("_s").over(w), F.lit(0)))
    inner = Window.partitionBy(*key, "_run").orderBy(ord_).rowsBetween(Window.unboundedPreceding, 0)
    d = _back(d.withColumn("_i", F.sum("_v").over(inner)), _renamed(sums, key, "_b"), key)
    return d.withColumn(name, F.col("_i") + F.col("_b")).drop("_v", "_run", "_i", "_b")


def neighbour(df: DataFrame, key: list[str], ord_: str, cols: list[str], name: str, after: bool = False, size: int = SIZE) -> DataFrame:
    """``df`` with ``name``: a struct of ``cols`` of the row before (or after) in the key;
    null for the first (or last)."""
    d = _cut(df.withColumn("_v", F.struct(*cols)), ord_, size)
    pick = F.min_by if after else F.max_by
    ends = d.groupBy(*key, "_run").agg(pick("_v", F.col(ord_)).alias("_e"))
    w = Window.partitionBy(*key).orderBy("_run")
    ends = ends.withColumn("_c", (F.lead if after else F.lag)("_e").over(w))
    inner = Window.partitionBy(*key, "_run").orderBy(ord_)
    d = _back(d.withColumn("_i", (F.lead if after else F.lag)("_v").over(inner)), _renamed(ends, key, "_c"), key)
    return d.withColumn(name, F.coalesce("_i", "_c")).drop("_v", "_run", "_i", "_c")
