"""What changed between full snapshots of a table.

``SnapshotIndex`` keeps, for the last snapshot, a bucketed table of key and hash
of the compared values, by name in the shared folder. A new snapshot's keys and hashes
are put into the same buckets and probe the index, which is read in place; old values are
fetched from the old snapshot for changed keys only; then the new snapshot's index takes
the old one's place.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.session import shared_dir, written

KIND = "change_kind"


def folded(col: str) -> Column:
    """Values that differ in letter case or the amount of white space only are equal,
    and an empty string equals null."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(F.col(col).cast("string")), r"(?U)\s+", " ")), F.lit(""))


def row_hash(cols: list[str]) -> Column:
    """128 bits over the folded values; null and each value differ, and so do columns."""
    parts = [F.coalesce(F.concat(F.lit("="), folded(c)), F.lit("-")) for c in cols]
    return F.md5(F.concat_ws("\x1f", *parts))


def keyed(df: DataFrame, key: list[str], compared: list[str], latest: str | None) -> DataFrame:
    """One row per key: ``key`` and ``_h``. Of repeats the one with the last
    ``latest`` counts (null is first), ties by the greater hash. The choice is an
    aggregate, so repeats of a hot key meet on the map side."""
    h = row_hash(compared)
    order = F.struct(F.col(latest), h) if latest else F.struct(h)
    return df.groupBy(*key).agg(F.max_by(h, order).alias("_h"))


class SnapshotIndex:
    """The index of the last snapshot, kept under ``name`` in the shared folder (or
    ``folder``); ``apply`` brings the next one, also in a later session.

    Null key parts are equal to each other. A first snapshot reports every key as
    added unless it comes through ``load``; an empty snapshot removes every key.
    A delivery that fails leaves the index as it was: the new one is put in the old one's
    place by a rename, after what changed has been written.
    """

    #: Keys of a bucket, roughly.
    BUCKET = 250_000

    def __init__(self, spark: SparkSession, name: str, key: list[str], compared: list[str], latest: str | None = None, folder: str | None = None):
        self.spark, self.key, self.compared, self.latest = spark, key, compared, latest
        self.path = f"{folder or shared_dir(spark)}/index-{name}"

    # --- files ---
    def _fs(self):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def versions(self) -> list[tuple[int, int]]:
        """(number, buckets) of the versions in place, the last one last."""
        fs, path = self._fs()
        if not fs.exists(path(self.path)):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(path(self.path))]
        return sorted(tuple(map(int, n[1:].split("-"))) for n in names if re.fullmatch(r"v\d+-\d+", n))

    def _table(self, path: str, buckets: int, frame: DataFrame | None = None) -> DataFrame:
        """The bucketed table at ``path``, written from ``frame`` first if that is given. The
        frame knows its files and buckets, so the catalogue needs no entry."""
        name = f"foliant_index_{uuid.uuid4().hex}"
        if frame is not None:
            # by key within as many partitions as buckets: one file per bucket
            w = frame.repartition(buckets, *self.key).write.format("parquet").option("path", path)
            w.bucketBy(buckets, *self.key).sortBy(*self.key).saveAsTable(name)
        else:
            by = ", ".join(f"`{k}`" for k in self.key)
            cols = ", ".join(f"`{k}` STRING" for k in [*self.key, "_h"])
            self.spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
        out = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return out

    def held(self) -> DataFrame | None:
        """Key and hash of the last snapshot."""
        v = self.versions()
        return self._table(f"{self.path}/v{v[-1][0]}-{v[-1][1]}", v[-1][1]) if v else None

    def drop(self) -> None:
        fs, path = self._fs()
        fs.delete(path(self.path), True)

    # --- deliveries ---
    def _keyed(self, snapshot: DataFrame) -> DataFrame:
        # null parts must meet: they are held as a marked string beside the value
        parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{k}`").cast("string")), F.lit("-")).alias(k) for k in self.key]
        kept = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(self.compared)] + ([F.col(f"`{self.latest}`").alias("_t")] if self.latest else [])
        return keyed(snapshot.select(*parts, *kept), self.key, [f"_c{i}" for i in range(len(self.compared))], "_t" if self.latest else None)

    def _next(self, snapshot: DataFrame) -> tuple[DataFrame, str, int]:
        """The new snapshot's index, written beside the one in place. The number of buckets
        follows the number of keys, and stays as it is while that is about right."""
        old = self.versions()
        rows = (self.held() if old else snapshot).count()
        buckets = max(1, -(-rows // self.BUCKET))
        if old and old[-1][1] / 4 <= buckets <= old[-1][1] * 2:
            buckets = old[-1][1]
        path = f"{self.path}/next-{uuid.uuid4().hex}"
        return self._table(path, buckets, self._keyed(snapshot)), path, buckets

    def _swap(self, path: str, buckets: int) -> None:
        fs, hadoop = self._fs()
        old = self.versions()
        if not fs.rename(hadoop(path), hadoop(f"{self.path}/v{(old[-1][0] if old else 0) + 1}-{buckets}")):
            raise OSError(f"{path} was not put in place")
        for n, b in old:
            fs.delete(hadoop(f"{self.path}/v{n}-{b}"), True)

    def load(self, snapshot: DataFrame) -> None:
        """Take ``snapshot`` as the last one, without a report."""
        _, path, buckets = self._next(snapshot)
        self._swap(path, buckets)

    def apply(self, snapshot: DataFrame, before: DataFrame | None = None) -> DataFrame:
        """Rows of ``key`` and ``change_kind`` (added, removed, changed) against the
        last snapshot; the index then holds ``snapshot``. With ``before``, the last snapshot
        itself, also structs ``old`` and ``new`` of the compared values, fetched for the keys
        in the report alone. The report is a table of its own in the shared folder."""
        fresh, path, buckets = self._next(snapshot)
        out = written(self.probe(self.held(), fresh))
        if before is not None:
            out = written(with_values(out, before, snapshot, self.key, self.compared, self.latest))
        self._swap(path, buckets)
        return out

    def probe(self, held: DataFrame | None, fresh: DataFrame) -> DataFrame:
        plain = [F.when(F.col(k) != "-", F.expr(f"substring(`{k}`, 2)")).alias(k) for k in self.key]
        new = fresh.withColumnRenamed("_h", "_new")
        if held is None:
            return new.select(*plain, F.lit("added").alias(KIND))
        kind = F.when(F.col("_was").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed")
        # both lie in the same buckets: no shuffle
        met = held.withColumnRenamed("_h", "_was").join(new, self.key, "full_outer").where(~F.col("_was").eqNullSafe(F.col("_new")))
        return met.select(*plain, kind.alias(KIND))


def with_values(changes: DataFrame, old: DataFrame, new: DataFrame, key: list[str], compared: list[str], latest: str | None = None) -> DataFrame:
    """``changes`` with structs ``old`` and ``new`` of the compared values, fetched for
    the changed keys only. Keys are compared as strings; of repeats the one that ``keyed``
    takes counts."""
    out = changes
    for frame, name in ((old, "old"), (new, "new")):
        h = row_hash(compared)
        order = F.struct(F.col(f"`{latest}`"), h) if latest else F.struct(h)
        cols = [F.col(f"`{k}`").cast("string").alias(f"_k{i}") for i, k in enumerate(key)]
        s = frame.select(*cols, F.struct(*[F.col(f"`{c}`") for c in compared]).alias("_v"), order.alias("_o"))
        meet = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
        s = s.join(changes.select(*key), meet, "left_semi").groupBy(*[f"_k{i}" for i in range(len(key))]).agg(F.max_by("_v", "_o").alias(name))
        out = out.join(s, meet, "left").drop(*[f"_k{i}" for i in range(len(key))])
    return out


def changes_over(df: DataFrame, period: str, key: list[str], compared: list[str], latest: str | None = None, values: bool = False) -> DataFrame:
    """``period``, ``key`` and ``change_kind`` (with ``values`` also ``old`` and ``new``) for every
    period but the first, each against the one just before: the snapshots are delivered in
    turn to one index, which is dropped at the end.

    The periods (one per delivery) are the only rows that reach the driver. Rows without a
    period are left out.
    """
    index = SnapshotIndex(df.sparkSession, uuid.uuid4().hex, key, compared, latest)
    periods = [r[0] for r in df.where(F.col(period).isNotNull()).select(period).distinct().orderBy(period).collect()]
    out: DataFrame | None = None
    last: DataFrame | None = None
    for p in periods:
        snapshot = df.where(F.col(period) == F.lit(p))
        if last is None:
            index.load(snapshot)
        else:
            got = index.apply(snapshot, last if values else None)
            got = got.select(F.lit(p).cast(df.schema[period].dataType).alias(period), *got.columns)
            out = got if out is None else out.unionByName(got)
        last = snapshot
    index.drop()
    if out is None:
        own = F.lit(None).cast(T.StructType([df.schema[c] for c in compared]))
        return df.select(period, *[F.col(k).cast("string").alias(k) for k in key], F.lit("").alias(KIND), *[own.alias(c) for c in ("old", "new") if values]).where(F.lit(False))
    return out
