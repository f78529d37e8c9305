"""Mixing sources to target weights.

Each source's documents stand in a fixed pseudo-random order, repeated as often as it
takes (``max_repeats`` at most), and are cut into blocks of ``block_tokens``. Pfair
scheduling interleaves the blocks: block ``i`` of a source with weight ``w`` is released
at slot ``floor(i / w)`` and due before slot ``ceil((i + 1) / w)``, and the earliest
deadline goes first, which keeps every source less than one block from its share at any
point. Weights are taken as the decimal fractions they are written as, so the schedule
repeats after their common denominator (equal weights of 1,500 sources: 1,500 slots); one
period is computed once and looked up by every block. Where that is more than ``GRID``
slots, weights are rounded to multiples of ``1 / GRID`` (or of a sixteenth of a source's
even share), which bends the order of the blocks by less than one in ``GRID``, never the
tokens that a source gives: these are whole numbers reckoned from the exact weights.

The running sum over a source, which may hold a third of all rows, is taken in two
levels: within hash buckets of a source, and over the buckets' totals.
"""

from __future__ import annotations

import heapq
import math
import os
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most slots of a period with exact weights; documents in one bucket of a source's running
#: sum, and most buckets of a source (beyond that buckets grow).
GRID, BUCKET, BUCKETS = 100_000, 500_000, 65_536


def token_counts(df: DataFrame, text: str, ranks_path: str, pattern: str) -> DataFrame:
    """``df`` with ``n_tokens`` under the byte-pair ranks at ``ranks_path`` (one base64
    token and its rank per line), a file of the driver's that is shipped to the executors.
    A null text has none; marks of special tokens are ordinary text."""
    df.sparkSession.sparkContext.addFile(ranks_path)
    name = os.path.basename(ranks_path)

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import base64

        import tiktoken

        with open(SparkFiles.get(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for s in batches:
            yield s.map(lambda t: len(enc.encode_ordinary(t)) if t else 0).astype("int64")

    keep = [F.col(f"`{c}`") for c in df.columns if c != "n_tokens"]
    return df.select(*keep, count(F.col(text)).alias("n_tokens"))


def exact(w: float) -> Fraction:
    """The decimal fraction that ``w`` is written as."""
    return Fraction(repr(float(w)))


def quotas(weights: dict[str, float | Fraction], grid: int = GRID) -> dict[str, int]:
    """Blocks of each source in one period: exact where the weights' common denominator is
    within ``grid``, otherwise by largest remainder over ``grid`` slots (sixteen and more per
    source), where each source with a weight has one at least."""
    live = {s: w if isinstance(w, Fraction) else exact(w) for s, w in weights.items() if w > 0}
    total = sum(live.values())
    part = {s: w / total for s, w in live.items()}
    whole = math.lcm(*(f.denominator for f in part.values()))
    if whole <= grid:
        return {s: int(f * whole) for s, f in part.items()}
    grid = max(grid, 16 * len(part))
    n = {s: max(1, int(f * grid)) for s, f in part.items()}
    over = sum(n.values()) - grid
    # sources with the least (or, to take slots away, the most) against their weight first
    order = sorted(part, key=lambda s: (n[s] - part[s] * grid, s), reverse=over > 0)
    at = 0
    while over:
        s = order[at % len(order)]
        if over < 0 or n[s] > 1:
            n[s] -= 1 if over > 0 else -1
            over -= 1 if over > 0 else -1
        at += 1
    return n


def period(n: dict[str, int]) -> list[str]:
    """The source of every slot of one period: earliest deadline first among the released
    blocks (ties by source)."""
    grid = sum(n.values())
    coming = []
    for s, k in n.items():
        w = Fraction(k, grid)
        for i in range(k):
            coming.append((int(i / w), -int(-(i + 1) // w), s))
    coming.sort()
    out: list[str] = []
    ready: list[tuple[int, str]] = []
    at = 0
    for slot in range(grid):
        while at < len(coming) and coming[at][0] <= slot:
            heapq.heappush(ready, (coming[at][1], coming[at][2]))
            at += 1
        due, s = heapq.heappop(ready)
        assert due > slot
        out.append(s)
    return out


@dataclass(frozen=True)
class Plan:
    """What each source gives: ``need`` tokens (whole, never more than ``repeats * size``)
    of ``size``, and its exact share."""

    need: dict[str, int]
    size: dict[str, int]
    part: dict[str, Fraction]


def plan(sizes: dict[str, int], weights: dict[str, float], repeats: dict[str, int]) -> Plan:
    """The largest mixture that meets the weights within the repeats. Sources without a
    token or a weight are left out and the other weights scaled up."""
    live = {s: exact(w) for s, w in weights.items() if w and w > 0 and sizes.get(s, 0) > 0 and repeats.get(s, 0) > 0}
    scale = sum(live.values())
    part = {s: w / scale for s, w in live.items()}
    total = min((repeats[s] * sizes[s] / p for s, p in part.items()), default=Fraction(0))
    # rounded down: a need is at most repeats * size, so no document is used once too often
    return Plan({s: math.floor(p * total) for s, p in part.items()}, {s: sizes[s] for s in live}, part)


def mix(docs: DataFrame, targets: DataFrame, source: str = "source", doc_id: str = "doc_id", block_tokens: int = 20_000) -> DataFrame:
    """The mixture: one row per use of a document, with ``slot`` (place of its block in the
    mixture), ``block_no``, ``start`` (its first token in its source's sequence),
    ``copy_no`` from 1 and ``n_tokens``.

    ``docs`` has ``n_tokens``; documents without tokens are not drawn. ``targets``
    (source, weight, max_repeats) is a table of one row per source, held by the driver;
    of repeated sources the greatest weight counts. ``docs`` is read twice (sizes, then
    draws): give it materialised if it is dear. An empty side gives an empty mixture.
    """
    d = docs.where((F.col("n_tokens") > 0) & F.col(source).isNotNull()).select(F.col(source).alias("source"), F.col(doc_id).alias("doc_id"), "n_tokens")
    t = {r.source: r for r in targets.groupBy("source").agg(F.max("weight").alias("weight"), F.max("max_repeats").alias("max_repeats")).collect() if r.source is not None}
    d = d.where(F.col("source").isin(*t)) if t else d.where(F.lit(False))
    d = d.withColumn("_h", F.xxhash64("source", "doc_id"))
    n = d.groupBy("source").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("size")).collect()
    got = plan({r.source: r["size"] for r in n}, {s: r.weight for s, r in t.items()}, {s: int(r.max_repeats or 0) for s, r in t.items()})
    buckets = min(BUCKETS, max([16, *(-(-r.n // BUCKET) for r in n)]))
    d = d.withColumn("_b", F.pmod(F.shiftright("_h", 20), F.lit(buckets)).cast("int"))

    spark = docs.sparkSession
    before = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = d.groupBy("source", "_b").agg(F.sum("n_tokens").alias("_s")).withColumn("_base", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    inside = Window.partitionBy("source", "_b").orderBy("_h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_off", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(sums, ["source", "_b"])

    rows = [(s, got.need[s], got.size[s], -(-got.need[s] // got.size[s])) for s in got.need if got.need[s]]
    share = spark.createDataFrame(rows, "source string, need long, size long, copies int")
    d = d.join(F.broadcast(share), "source").withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    d = d.withColumn("start", F.col("_k") * F.col("size") + F.col("_base") + F.col("_off")).where(F.col("start") < F.col("need"))
    d = d.withColumn("block_no", F.floor(F.col("start") / block_tokens).cast("long"))

    slots: dict[str, list[int]] = {s: [] for s in got.part}
    per = quotas(got.part) if got.part else {}
    for at, s in enumerate(period(per)):
        slots[s].append(at)
    grid = sum(per.values())
    table = spark.createDataFrame(list(slots.items()), "source string, slots array<int>")
    d = d.join(F.broadcast(table), "source")
    k = F.size("slots")
    slot = F.floor(F.col("block_no") / k).cast("long") * grid + F.get("slots", (F.col("block_no") % k).cast("int"))
    return d.select("source", "doc_id", slot.alias("slot"), "block_no", "start", (F.col("_k") + 1).cast("int").alias("copy_no"), "n_tokens")


def shares(mixture: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source of the targets: weight, tokens, share really reached, documents used and
    the most uses of one document."""
    per = mixture.groupBy("source", "doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("uses"))
    got = per.groupBy("source").agg(F.sum("n").alias("tokens"), F.count("*").alias("documents"), F.max("uses").alias("most_uses"))
    out = targets.groupBy("source").agg(F.max("weight").alias("weight")).join(got, "source", "left").fillna(0, ["tokens", "documents", "most_uses"])
    return out.withColumn("share", F.col("tokens") / F.greatest(F.lit(1), F.sum("tokens").over(Window.partitionBy(F.lit(1)))))
