"""Usage counting over a call-log stream (STR-2).

Every micro-batch adds the calls that the call log does not hold yet, by their
event id, and the days it touches are counted again from the log
(``sinks/call_log.py``). Counters are therefore absolute: a replayed batch, or
the same calls under another checkpoint, change nothing, and a call that
arrives late, however late, is counted on its day.

``usage_counts_stream`` is the stateful alternative for sinks that want the
counts as a stream; there the caller states how late a call may be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.usage import billable_calls
from quayside.schemas import USAGE_TABLE
from quayside.sinks import call_log
from quayside.sinks.publish import Target, publish_one, read_live


def usage_counts_stream(calls: DataFrame, watermark: str, policy: str = "code") -> DataFrame:
    """Streaming counter rows ``(usage_date, endpoint, call_count,
    created_at, updated_at)``, absolute per window. Calls later than
    ``watermark`` are not counted; :func:`sync_usage` has no such limit."""
    # Watermarks need zone-aware event time; the log's stamps are UTC wall
    # clock, and the session zone is UTC, so the cast keeps the day.
    return (billable_calls(calls, policy).withColumn("_event_time", F.col("ts").cast("timestamp"))
            .withWatermark("_event_time", watermark)
            .groupBy(F.window("_event_time", "1 day").alias("w"), "endpoint")
            .agg(F.count(F.lit(1)).alias("call_count"), F.min("ts").alias("created_at"),
                 F.max("ts").alias("updated_at"))
            .select(F.to_date(F.col("w.start").cast("timestamp_ntz")).alias("usage_date"), "endpoint", "call_count",
                    "created_at", "updated_at"))


def sync_usage(spark: SparkSession, calls_stream: DataFrame, target: Target, name: str, checkpoint: str,
               policy: str = "code") -> None:
    """Maintain the counter table from a call-log stream and stop when the
    available input is consumed."""
    log = f"{target.table(name)}_log"

    def apply(batch: DataFrame, batch_id: int) -> None:
        days = call_log.append_calls(spark, batch, log, policy)
        if days:
            merged = call_log.counted_usage(spark, read_live(spark, target, name, USAGE_TABLE), log, days)
            publish_one(merged, target, name, f"b{batch_id:012d}")

    q = (calls_stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
