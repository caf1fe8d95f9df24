"""Incremental runs as Structured Streaming (STR-1..3).

STR-1: documents landed as JSON files are read as a stream with the declared
schema; each micro-batch is flattened, staged once, and upserted into the live
table (``foreachBatch``), touching only the partitions it carries, and
published under a new pointer. ``availableNow`` runs the backlog to completion
and stops, which is the scheduled run of the reference. A replayed batch, or a
stream restarted with a new checkpoint, upserts the same rows again under
another pointer, so the table is the same.

STR-3: rows carry their document's order (file time, file name, block, line)
and the point's position. Of two documents for a date, also in one batch, the
later one wins.

What cannot be stored (documents that do not decode or hold no item, points
that a NOT NULL column rejects) goes to the table ``<name>_rejects``, one
partition per batch of a stream.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.flatten import SEQ, flatten_sales
from quayside.operators.upsert import upsert_sales
from quayside.operators.validate import split_valid_rows
from quayside.schemas import CORRUPT, SALES_DOC, SALES_REQUIRED, SALES_TABLE
from quayside.sinks.publish import Target, publish_one, read_live
from quayside.sources import payloads

ORDER = ["file_time", "file", "block", "line"]
NOT_NULL = list(SALES_REQUIRED) + ["estimated_units_sold", "last_known_price"]


def landed_sales_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(SALES_DOC).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    m = "_metadata."
    return reader.json(landing_dir).select(
        "*", F.col(m + "file_modification_time").alias("file_time"), F.col(m + "file_path").alias("file"),
        F.col(m + "file_block_start").alias("block"))


def sync_landed_sales(spark: SparkSession, landing_dir: str, target: Target, name: str, checkpoint: str,
                      as_of: dt.datetime, marketplace: str = "us", max_files_per_trigger: int | None = None,
                      partition_by: str = "date", schema: T.StructType | None = None) -> None:
    """Run every landed sales document into ``target``/``name`` and stop.
    ``schema`` is the table's schema (default: the live table's, or the
    sales table's when the live table is empty and has no files to read)."""
    if schema is None:
        try:
            schema = read_live(spark, target, name).schema
        except FileNotFoundError:  # no live version
            schema = SALES_TABLE
        except AnalysisException as e:  # an empty one, with no schema to infer; anything else is a failure
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            schema = SALES_TABLE

    def apply(batch: DataFrame, batch_id: int) -> None:
        # Parsed and flattened once: the checkpoints are read by the upsert (its folders, its rows) and by the rejects.
        docs = batch.withColumn("line", F.monotonically_increasing_id()).checkpoint(eager=True)
        rows = flatten_sales(payloads.good_documents(docs), marketplace=marketplace, first_item_only=True, order=ORDER)
        rows = rows.checkpoint(eager=True)
        rows, rejected = split_valid_rows(rows, NOT_NULL)
        live = read_live(spark, target, name, schema)
        merged = upsert_sales(live, rows, as_of, partition_by=[partition_by], seq=SEQ, touched_only=True)
        publish_one(merged.drop("action"), target, name, f"b{batch_id:012d}", partition_by=partition_by,
                    merge_partitions=True)
        where = F.struct(*ORDER)
        rejects = (payloads.quarantine(docs).select(where.alias("at"), "reason", F.col("raw").alias("detail"))
                   .unionByName(payloads.empty_documents(docs).select(where.alias("at"), "reason",
                                                                      F.lit(None).cast("string").alias("detail")))
                   .unionByName(rejected.select(F.col(f"{SEQ}._doc").alias("_d"), F.col("reject_reason").alias("reason"),
                                                F.to_json(F.struct("asin", "date")).alias("detail"))
                                .select(F.struct(*[F.col(f"_d.{c}") for c in ORDER]).alias("at"), "reason", "detail")))
        # The batch number alone would clash with another stream's.
        key = f"{uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]}-{batch_id}"
        publish_one(rejects.withColumn("batch", F.lit(key)), target, f"{name}_rejects", key, partition_by="batch",
                    merge_partitions=True, replaced={key})

    q = (landed_sales_stream(spark, landing_dir, max_files_per_trigger).writeStream
         .foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
