"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def make_session(app: str = "foliant", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings that the engine assumes (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FOLIANT_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only where that is unset (tests,
    local runs) a temporary folder is made and set, so a cluster never gets a
    machine-local one."""
    ctx = spark.sparkContext
    held = ctx._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not ctx.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        local = tempfile.mkdtemp(prefix="foliant-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        named = "file://" + local
    ctx.setCheckpointDir(named)
    return ctx._jsc.sc().getCheckpointDir().get().rstrip("/")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage: written as parquet to the shared folder and read back. Its
    shuffle files go as soon as it is written, not when the driver happens to collect garbage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    held = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if held is None else spark.conf.set(CLEANUP, held)
    return spark.read.schema(df.schema).parquet(path)


#: What this process has written to the shared folder.
_WRITTEN: list[str] = []


def clear(spark: SparkSession) -> int:
    """Remove the tables that ``written`` left, once no result reads them any more; how many."""
    jvm, n = spark._jvm, len(_WRITTEN)
    for path in _WRITTEN:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _WRITTEN.clear()
    return n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
