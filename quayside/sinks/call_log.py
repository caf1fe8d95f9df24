"""The log of counted API calls: each call once, whoever brings it (STR-2, SNK-3, UPS-5).

Calls are known by their ``event_id`` (a call without one by a digest of its
columns). The log is partitioned by day and only ever appended to: calls that
the day's folder already holds are left out, so a replayed batch, a new
checkpoint or a repeated run adds nothing, and a write that stopped half way
is completed by the next. Daily counters are counted from the log, hence
absolute: they have no memory of batches, versions or pointers.

One writer at a time, as for the published tables. A call's day comes from its
time stamp, so two rows of one id on one day are one call (the earlier row),
and on two days two.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.usage import billable_calls
from quayside.session import ensure_checkpoint_dir

LOG_SCHEMA = "call_key string, endpoint string, ts timestamp_ntz, usage_date date"


def keyed_calls(calls: DataFrame, policy: str = "code") -> DataFrame:
    """The calls that count, one row per key and day (columns of ``LOG_SCHEMA``)."""
    known = F.col("event_id").cast("string") if "event_id" in calls.columns else F.lit(None).cast("string")
    digest = F.sha2(F.to_json(F.struct(*sorted(calls.columns))), 256)
    return (billable_calls(calls, policy)
            .select(F.coalesce(known, F.concat(F.lit("sha256:"), digest)).alias("call_key"), "endpoint", "ts",
                    F.to_date("ts").alias("usage_date"))
            .groupBy("usage_date", "call_key").agg(F.min(F.struct("ts", "endpoint")).alias("call"))
            .select("call_key", "call.endpoint", "call.ts", "usage_date"))


def read_days(spark: SparkSession, path: str, days: list[dt.date]) -> DataFrame:
    """The logged calls of ``days``; only their folders are listed and read."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folders = [f"{path}/usage_date={d.isoformat()}" for d in days]
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    held = [f for f in folders if fs.exists(hadoop(f))]
    if not held:
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).option("basePath", path).parquet(*held)


def append_calls(spark: SparkSession, calls: DataFrame, path: str, policy: str = "code") -> list[dt.date]:
    """Add the calls that the log does not hold; returns the days the calls touch.

    The semi-join's small side is the batch, which AQE broadcasts by its
    checked size, so a long day's folder is scanned for its keys and not shuffled."""
    ensure_checkpoint_dir(spark)
    batch = keyed_calls(calls, policy).checkpoint(eager=True)
    days = sorted(r[0] for r in batch.select("usage_date").distinct().collect() if r[0] is not None)
    if days:
        keys = ["usage_date", "call_key"]
        seen = read_days(spark, path, days).select(*keys).join(batch.select(*keys), keys, "left_semi")
        fresh = batch.where("usage_date IS NOT NULL").join(seen, keys, "left_anti")
        fresh.select("call_key", "endpoint", "ts", "usage_date").write.mode("append").partitionBy("usage_date").parquet(path)
    return days


def daily_counts(spark: SparkSession, path: str, days: list[dt.date]) -> DataFrame:
    """Counter rows of ``days`` (AGG-3's columns), counted from the log."""
    return (read_days(spark, path, days).groupBy("usage_date", "endpoint")
            .agg(F.count(F.lit(1)).alias("call_count"), F.min("ts").alias("created_at"), F.max("ts").alias("updated_at")))


def counted_usage(spark: SparkSession, live: DataFrame, path: str, days: list[dt.date]) -> DataFrame:
    """The counter table with the rows of ``days`` as the log has them; other rows stay as they are."""
    both = live.withColumn("_now", F.lit(0)).unionByName(daily_counts(spark, path, days).withColumn("_now", F.lit(1)))
    last = F.max_by(F.struct("call_count", "created_at", "updated_at"), "_now").alias("_r")
    return both.groupBy("usage_date", "endpoint").agg(last).select("usage_date", "endpoint", "_r.*")
