"""Streaming queries (STR-1..3): run to completion, then read the table back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quayside.plans.q_upsert import SALES_TARGET_SQL, UPSERT_SALES_SQL, sales_target
from quayside.plans.registry import query
from quayside.schemas import USAGE_TABLE
from quayside.session import ensure_checkpoint_dir
from quayside.sinks import call_log
from quayside.sinks.publish import Target, publish_one, read_live
from quayside.sources import standin_docs as D
from quayside.sources import standins as S
from quayside.sources.standins import AS_OF, with_views
from quayside.sources.tables import read_table
from quayside.streaming.landed import sync_landed_sales
from quayside.streaming.usage_stream import sync_usage


def _scratch(spark, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


FRESH_SQL = ("SELECT asin, marketplace, is_parent, date, estimated_units_sold, last_known_price FROM ("
             + D.sales_rows_sql(first_item_only=True) + ") r WHERE date IS NOT NULL")


@query("stream_landed_sales", with_views("SELECT * EXCLUDE (action) FROM m", "v_sales", extra={
    "pts": D.SALES_POINTS_SQL, "v_sales_new": FRESH_SQL, "tgt": SALES_TARGET_SQL, "m": UPSERT_SALES_SQL}))
def q_stream_landed_sales(spark, sf):
    """Sales documents land in two writes; the stream upserts eight files a
    micro-batch into the stored table (published as version 0) and the
    final table is read back. Bad points (no date) never reach the table."""
    root = _scratch(spark, "landed")
    target = Target(root, "dev_")
    publish_one(sales_target(spark, sf), target, "sales", "a000000000000", partition_by="date")
    docs = D.sales_documents(spark, sf).checkpoint(eager=True)  # written in two parts
    landing = f"{root}/landing"
    for parity in (0, 1):
        (docs.filter(F.col("doc_id") % 2 == parity).select("doc")
         .write.mode("append").text(landing))
    sync_landed_sales(spark, landing, target, "sales", f"{root}/_checkpoint", AS_OF, max_files_per_trigger=8)
    return read_live(spark, target, "sales").drop("action")


USAGE_COUNTS_SQL = with_views("""
SELECT CAST(ts AS DATE) AS usage_date, endpoint, count(*) AS call_count, min(ts) AS created_at, max(ts) AS updated_at
FROM v_calls WHERE status = 200 AND n_items > 0 GROUP BY 1, 2""", "v_calls")


@query("stream_usage_counts", USAGE_COUNTS_SQL)
def q_stream_usage_counts(spark, sf):
    """The event table read as a file stream; daily counts per endpoint
    kept in the counter table with absolute values per window."""
    root = _scratch(spark, "usage")
    target = Target(root, "dev_")
    publish_one(spark.createDataFrame([], USAGE_TABLE), target, "api_usage", "a000000000000")
    schema = read_table(spark, sf, "events").schema
    events = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .parquet(sf))
    sync_usage(spark, S.calls_from_events(events), target, "api_usage", f"{root}/_checkpoint")
    return read_live(spark, target, "api_usage", USAGE_TABLE)


@query("stream_usage_replayed", USAGE_COUNTS_SQL)
def q_stream_usage_replayed(spark, sf):
    """The event table as two streams with checkpoints of their own, and once
    more as a run's call log: every call counts once."""
    root = _scratch(spark, "usage")
    target = Target(root, "dev_")
    publish_one(spark.createDataFrame([], USAGE_TABLE), target, "api_usage", "a000000000000")
    schema = read_table(spark, sf, "events").schema
    for k in (1, 2):
        events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
        sync_usage(spark, S.calls_from_events(events), target, "api_usage", f"{root}/_checkpoint{k}")
    log = f"{target.table('api_usage')}_log"
    days = call_log.append_calls(spark, S.calls(spark, sf), log)
    return call_log.counted_usage(spark, read_live(spark, target, "api_usage", USAGE_TABLE), log, days)
