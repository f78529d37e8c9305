"""References to records that do not exist, with partial keys and validity in time.

A reference is several columns; some may be null. References are grouped by their
null mask; each mask is anti-joined with the targets on its non-null columns alone,
as the declared semantics ask:

* ``simple``  - a reference with any null is no reference (and never an orphan);
* ``full``    - all null is no reference; some null is an orphan (``partial``);
* ``partial`` - the non-null columns must match some target; all null is none.

A target row stands from ``since`` until just before ``until`` (null: still). The
reasons are ``missing`` (no such target at all), ``late`` (some row of it comes
after the reference), ``deleted`` (none comes after, none stands), ``partial``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.session import written

#: A key with more rows (of different starts) than this is judged by running counts in place
#: of the anti-join, in runs of so many microseconds.
FEW, RUN = 64, 3600 * 10**6


def masks(names: list[str], match: str) -> Iterator[tuple[list[str], list[str], str]]:
    """Per null mask its non-null and null columns and what the semantics make of it: ``match``
    (anti-join), ``orphan`` or ``none`` (no reference)."""
    for gone in product([False, True], repeat=len(names)):
        held, null = [c for c, g in zip(names, gone) if not g], [c for c, g in zip(names, gone) if g]
        if not null:
            yield held, null, "match"
        elif not held or match == "simple":
            yield held, null, "none"
        else:
            yield held, null, "orphan" if match == "full" else "match"


def orphans(refs: DataFrame, targets: DataFrame, on: dict[str, str], at: str, since: str, until: str, match: str = "simple") -> DataFrame:
    """``refs`` that no target satisfies at time ``at``, with the column ``reason``.

    ``on`` maps reference columns to target columns. A null ``at`` is later than all; a null
    ``since`` means from ever; a target whose ``until`` is not after ``since`` stands at no
    time but counts as existing. Repeated references stay repeated; an empty target table
    makes all of them ``missing``. Columns of ``targets`` other than those named play no
    part, so clashing names do no harm. ``refs`` must not hold columns that begin with ``_``.
    """
    if match not in ("simple", "full", "partial"):
        raise ValueError(f"match {match!r}")
    out: list[DataFrame] = []
    for held, null, way in masks(list(on), match):
        part = refs.where(functools.reduce(Column.__and__, [*[F.col(f"`{c}`").isNull() for c in null], *[F.col(f"`{c}`").isNotNull() for c in held]]))
        if way == "match":
            out.append(_unmatched(part, targets, {c: on[c] for c in held}, at, since, until))
        elif way == "orphan":
            out.append(part.withColumn("reason", F.lit("partial")))
    return functools.reduce(DataFrame.unionByName, out)


def _unmatched(part: DataFrame, targets: DataFrame, on: dict[str, str], at: str, since: str, until: str) -> DataFrame:
    """The references of one mask without a standing target on the columns ``on``. Most keys
    have one row, which an aggregate tells with its span; what these leave is anti-joined with
    the rows of the others."""
    ever, never, end = (F.lit(x).cast("timestamp") for x in ("0001-01-01 00:00:00", "9999-12-31 00:00:00", "9999-12-30 00:00:00"))
    keys, names = [f"_k{i}" for i in range(len(on))], [c for c in part.columns if c != "reason"]
    t = targets.where(functools.reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in on.values()]))
    t = t.select(*[F.col(f"`{c}`").alias(k) for k, c in zip(keys, on.values())], F.coalesce(F.col(f"`{since}`"), ever).alias("_a"), F.coalesce(F.col(f"`{until}`"), never).alias("_b"))
    # four things are told of it, so it is written once: a row per key
    per = written(t.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_a").alias("_a"), F.max("_b").alias("_b"), F.max(F.when(F.col("_a") > ever, F.col("_a"))).alias("_last")))

    r = part.select(*[F.col(f"`{c}`") for c in names])
    when = F.coalesce(F.col(f"`{at}`").cast("timestamp"), end)
    meet = lambda: [F.col(f"`{c}`") == F.col(k) for c, k in zip(on, keys)]
    stands = (F.col("_a") <= when) & (when < F.col("_b"))
    left = r.join(per.where("_n = 1").select(*keys, "_a", "_b"), [*meet(), stands], "left_anti")
    left = written(left.join(per.select(*keys, "_n", "_last"), meet(), "left").drop(*keys))

    # repeats and reloads melt on the map side
    rows = t.join(per.where("_n > 1").select(*keys), keys, "left_semi").groupBy(*keys, "_a").agg(F.max("_b").alias("_b"))
    few = left.where(F.coalesce("_n", F.lit(0)) <= FEW).join(rows, [*meet(), stands, F.col("_n") > 1], "left_anti")
    many = left.where(F.col("_n") > FEW)
    asked = many.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(on, keys)], when.alias("_at"))
    gaps = _at_gaps(asked, rows.join(per.where(F.col("_n") > FEW).select(*keys), keys, "left_semi"), keys)
    got = few.unionByName(many.join(gaps, [*meet(), when == F.col("_at")], "left_semi"))
    reason = F.when(F.col("_n").isNull(), "missing").when(F.col("_last") > when, "late").otherwise("deleted")
    return got.select(*[F.col(f"`{c}`") for c in names], reason.alias("reason"))


def _at_gaps(asked: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct (``keys``, ``_at``) at which no row stands: starts less ends so far is zero.
    The count is taken within runs of time, each of which hands its sum to the next, so that no
    key has to stand in one task."""
    stands = rows.where(F.col("_a") < F.col("_b"))
    turn = lambda c, d: stands.select(*keys, F.unix_micros(c).alias("_t"), F.lit(d).alias("_d"))
    turns = turn("_a", 1).unionAll(turn("_b", -1)).groupBy(*keys, "_t").agg(F.sum("_d").alias("_d"))
    asks = asked.distinct().select(*keys, F.unix_micros("_at").alias("_t"), F.lit(0).cast("long").alias("_d"), "_at")
    e = turns.withColumn("_at", F.lit(None).cast("timestamp")).unionByName(asks).withColumn("_run", F.floor(F.col("_t") / RUN))
    before = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    base = e.groupBy(*keys, "_run").agg(F.sum("_d").alias("_s")).withColumn("_base", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    # at one time starts and ends come before what is asked
    inner = Window.partitionBy(*keys, "_run").orderBy("_t", F.col("_at").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("_in", F.sum("_d").over(inner)).where(F.col("_at").isNotNull()).join(base, [*keys, "_run"])
    return e.where(F.col("_in") + F.col("_base") == 0).select(*keys, "_at")


def rates(found: DataFrame, refs: DataFrame, by: list[str]) -> DataFrame:
    """References and orphans per table and period."""
    n = refs.groupBy(*by).agg(F.count("*").alias("references"))
    o = found.groupBy(*by).agg(F.count("*").alias("orphans"))
    return n.join(o, by, "left").withColumn("orphans", F.coalesce("orphans", F.lit(0)))
