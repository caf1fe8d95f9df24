"""Append-only logs of the runs: handled documents, batches, status events, rejected rows.

A log is a folder of Parquet folders, one per run and part. Writing a part
again replaces it, so a repeated run has each part once; a part that a crash
cut short is missing or whole. Nothing is ever merged or rewritten.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sinks.publish import Target

STRING, LONG = T.StringType(), T.LongType()
HANDLED = (T.StructType().add("source", STRING).add("doc_key", STRING).add("outcome", STRING).add("run", STRING))
BATCHES = (T.StructType().add("run_id", STRING).add("batch_no", LONG).add("requested", LONG).add("returned", LONG)
           .add("stored", LONG).add("fetch_failed", T.BooleanType()))
EVENTS = (T.StructType().add("asin", STRING).add("seq", LONG).add("kind", STRING).add("at", T.TimestampNTZType())
          .add("error_text", STRING).add("target", STRING).add("run", STRING))

REJECTED = (T.StructType().add("source", STRING).add("asin", STRING).add("reason", STRING).add("detail", STRING)
            .add("run", STRING))


class RunLog:
    def __init__(self, spark: SparkSession, target: Target, name: str, schema: T.StructType):
        self.spark, self.schema, self.path = spark, schema, target.table(name)

    def _folder(self, run: str) -> str:
        # A run id may hold characters that a path may not.
        return f"{self.path}/{uuid.uuid5(uuid.NAMESPACE_URL, run).hex}"

    def put(self, df: DataFrame, run: str, part: str) -> None:
        """Replace one part of a run."""
        df.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self._folder(run)}/{part}")

    def read(self, run: str | None = None) -> DataFrame:
        """All rows, or one run's."""
        path = self.path if run is None else self._folder(run)
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(path)


def handled_log(spark: SparkSession, target: Target) -> RunLog:
    return RunLog(spark, target, "handled_documents", HANDLED)


def batch_log(spark: SparkSession, target: Target) -> RunLog:
    return RunLog(spark, target, "run_batches", BATCHES)


def event_log(spark: SparkSession, target: Target) -> RunLog:
    return RunLog(spark, target, "run_events", EVENTS)


def reject_log(spark: SparkSession, target: Target) -> RunLog:
    return RunLog(spark, target, "run_rejected_rows", REJECTED)


def of_target(events: DataFrame, target: str) -> DataFrame:
    """The events that change one target's status table (``both`` changes each)."""
    return events.where(F.col("target").isin(target, "both")).drop("target", "run")
