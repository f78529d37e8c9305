"""Incremental forms: streams over files with a batch twin for each result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.plans.intake import gate
from foliant.session import shared_dir


def drained(stream: DataFrame, mode: str = "append") -> DataFrame:
    """What the stream gives once it has read all that is there, as a table in the shared
    folder. The end of its input doesn't move the watermark past open windows; callers that
    want those too use a mode that emits them."""
    spark = stream.sparkSession
    at = f"{shared_dir(spark)}/s-{uuid.uuid4().hex}"
    if mode == "append":
        q = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{at}/state").option("path", f"{at}/rows").trigger(availableNow=True).start()
    else:
        # each epoch's state replaces the last one's
        q = (
            stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True)
            .foreachBatch(lambda df, epoch: df.write.mode("overwrite").parquet(f"{at}/rows")).start()
        )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/rows")


def events(spark: SparkSession, sf: str, name: str = "events") -> DataFrame:
    path = f"{sf}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path + "*")


def tumbling(df: DataFrame, ts: str = "ts", width: str = "1 hour") -> DataFrame:
    """Counts and sums per window and type; the same for streams and tables."""
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    w = df.withWatermark(ts, "1 day") if df.isStreaming else df
    g = w.groupBy(F.window(ts, width), "event_type").agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    return g.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", "cents")


def ingest(spark: SparkSession, drop: str, out: str, checkpoint: str) -> None:
    """New front pages in the folder ``drop`` (JSON: pub_id, text, sha256) go through the gate:
    their record is always written, their text only on a pass. Each file is taken once; a
    repeat of an epoch writes the same folder again."""
    schema = "pub_id string, text string, sha256 string"
    s = spark.readStream.schema(schema).json(drop).dropDuplicates(["pub_id", "sha256"])
    s = s.select("*", *[c.alias(k) for k, c in gate(F.col("text")).items()])

    def write(df: DataFrame, epoch: int) -> None:
        df.drop("text").write.mode("overwrite").parquet(f"{out}/records/epoch={epoch}")
        df.where("status = 'pass'").select("pub_id", "sha256", "text").write.mode("overwrite").parquet(f"{out}/texts/epoch={epoch}")

    s.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()


def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    return drained(tumbling(events(spark, sf)), "complete")


def stream_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """First rows of each (user, type): stateful de-duplication."""
    s = events(spark, sf).select("user_id", "event_type").dropDuplicates(["user_id", "event_type"])
    return drained(s)


def session_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of users: events at most half an hour apart."""
    from foliant.session import table

    d = table(spark, sf, "events").where("user_id is not null and ts is not null")
    g = d.groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.count("*").alias("n"))
    return g.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


QUERIES = {f.__name__: f for f in (stream_tumbling, stream_distinct, session_batches)}
SQL = {
    "stream_tumbling": "select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as start, event_type, count(*) as n, cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents from events group by all",
    "stream_distinct": "select distinct user_id, event_type from events",
    "session_batches": """select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as start, count(*) as n from (select *, sum(new) over (partition by user_id order by ts rows between unbounded preceding and current row) as no from (
      select *, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end as new from events where user_id is not null and ts is not null)) group by user_id, no""",
}
