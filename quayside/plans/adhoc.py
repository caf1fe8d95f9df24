"""Ad-hoc syncs: requests and their responses, many at a time (PLN-3, PLN-4, FLT, UPS-1, UPS-3, RPT-9, SNK-1).

The reference answers one request at a time. Here any number of requests is
one job: their responses are parsed, flattened and merged together, staging
first and production after it, and every request gets its own answer row. Of
requests that bring the same key, the later id wins, as if they had come one
after the other; the first of them counts an insert, the others updates.

Answers have the outcome ``ok``, the reason a request was turned down for
(``missing_required``, ``no_keys``, ...), ``no_response`` (none landed),
``parse_error``, ``empty_response``, ``bad_point`` (a point without a usable
date: nothing of that response is stored), ``staging_failed`` or
``production_failed`` (staging has the rows). Counts of what was not written
are zero.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.dates import date_lit, lenient_date
from quayside.operators import flatten as flt
from quayside.operators import upsert as ups
from quayside.plans import windows
from quayside.plans.runs import PRODUCT_TABLE, SALES, RunTargets, _failed_write, _publish_table, _write_sales
from quayside.schemas import SALES_TABLE
from quayside.sinks.publish import Target, read_live
from quayside.sources import payloads

COUNTS = [f"{t}_{a}" for t in ("staging", "production") for a in (ups.INSERTED, ups.UPDATED)]


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def _shuffled(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the requests. Its size is guessed from compressed files, often far too low, and
    without the hint it (or the documents' text on the other side) may be broadcast, through the driver's memory."""
    return side.hint("merge")


def _parsed(requests: DataFrame, responses: DataFrame, read, *carried: str) -> DataFrame:
    """The accepted requests' responses, parsed once, with the request's columns named."""
    accepted = requests.where("rejected IS NULL").select("request_id", *carried)
    return read(responses.select("request_id", "doc").join(_shuffled(accepted), "request_id")).checkpoint(eager=True)


def _write_counts(rows: DataFrame, stored: DataFrame, keys: list[str], target: str) -> DataFrame:
    """Inserted and updated rows per request: a row inserts if its key is not stored and no earlier row brings it."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(flt.SEQ))
    marked = (rows.withColumn("first", place == 1)
              .join(_shuffled(stored.select(*keys).distinct().withColumn("there", F.lit(True))), keys, "left"))
    new = F.col("first") & F.col("there").isNull()
    return marked.groupBy("request_id").agg(F.count_if(new).alias(f"{target}_{ups.INSERTED}"),
                                            F.count_if(~new).alias(f"{target}_{ups.UPDATED}"))


def _answers(requests: DataFrame, documents: DataFrame, counts: list[DataFrame], failed_at: str | None) -> DataFrame:
    out = requests.join(_shuffled(documents), "request_id", "left")
    for c in counts:
        out = out.join(_shuffled(c), "request_id", "left")
    outcome = F.coalesce(F.col("rejected"), F.col("outcome"), F.lit("no_response"))
    if failed_at:
        outcome = F.when(outcome == "ok", F.lit(f"{failed_at}_failed")).otherwise(outcome)
    written = {"staging": failed_at != "staging", "production": failed_at is None}
    return out.withColumns({"outcome": outcome, **{
        c: F.coalesce(F.col(c), F.lit(0)) if written[c.split("_")[0]] else F.lit(0).cast("long") for c in COUNTS}})


def _sides(targets: RunTargets) -> list[tuple[str, Target]]:
    return [("staging", targets.staging), ("production", targets.production)]


def sync_products(requests: DataFrame, responses: DataFrame, targets: RunTargets, as_of: dt.datetime,
                  version: str) -> DataFrame:
    """``requests`` (request_id, asins) and ``responses`` (request_id, doc) -> one row per request: request_id,
    report_date, outcome, asins_requested, products_found, and inserted and updated rows of each target."""
    n = F.coalesce(F.size("asins"), F.lit(0))
    asked = requests.select("request_id", n.cast("long").alias("asins_requested"),
                            F.when(n < 1, "no_keys").when(n > windows.MAX_KEYS_PER_REQUEST, "too_many_keys").alias("rejected"))
    parsed = _parsed(asked, responses, payloads.read_product_payloads)
    rows = (flt.flatten_products(payloads.good_documents(parsed), as_of.date(), as_of, order=["request_id"])
            .withColumn("request_id", F.col(f"{flt.SEQ}.request_id")).checkpoint(eager=True))
    stored = rows.drop(flt.SEQ, "request_id")
    counts, failed_at = [], None
    keyed = rows.where(F.col("asin").isNotNull())
    for name, target in _sides(targets):
        live = read_live(rows.sparkSession, target, PRODUCT_TABLE, stored.schema)
        today = live.where(F.col("report_date") == date_lit(as_of.date()))
        counts.append(_write_counts(keyed, today, ups.PRODUCT_KEYS, name).checkpoint(eager=True))
    if not keyed.isEmpty():
        live = read_live(rows.sparkSession, targets.staging, PRODUCT_TABLE, stored.schema)
        merged = ups.upsert_products(live, rows.drop("request_id"), as_of, partition_by=["report_date"], seq=flt.SEQ,
                                     touched_only=True)
        failed_at, _ = _failed_write(
            _publish_table(merged.drop("action"), PRODUCT_TABLE, version, targets, "adhoc", partition_by="report_date",
                           merge_partitions=True, on_error="log"), targets)
    documents = payloads.document_summary(parsed).groupBy("request_id").agg(
        F.coalesce(F.max(F.when(F.col("outcome") != "ok", F.col("outcome"))), F.lit("ok")).alias("outcome"),
        F.coalesce(F.sum("n_items"), F.lit(0)).alias("products_found"))
    return _answers(asked, documents, counts, failed_at).select(
        "request_id", date_lit(as_of.date()).alias("report_date"), "outcome", "asins_requested",
        F.coalesce("products_found", F.lit(0)).alias("products_found"), *COUNTS)


def sync_sales(requests: DataFrame, responses: DataFrame, targets: RunTargets, as_of: dt.datetime,
               version: str) -> DataFrame:
    """``requests`` (request_id, asin, marketplace, start_date, end_date as text) and ``responses`` (request_id, doc)
    -> one row per request: its keys, the window with what was changed about it, outcome, total_records, and inserted
    and updated rows of each target. A window longer than a year starts one year before its end."""
    start, end = lenient_date(F.col("start_date")), lenient_date(F.col("end_date"))
    rejected = (F.when(_blank("asin") | _blank("marketplace") | _blank("start_date") | _blank("end_date"), "missing_required")
                .when(start.isNull(), "bad_start_date").when(end.isNull(), "bad_end_date"))
    asked = windows.clamp_window(requests.select("request_id", "asin", "marketplace", start.alias("start_date"),
                                                 end.alias("end_date"), rejected.alias("rejected")))
    parsed = _parsed(asked, responses, payloads.read_sales_payloads, "marketplace")
    order = ["request_id", "marketplace"]
    rows = (flt.flatten_sales(payloads.good_documents(parsed), marketplace="", first_item_only=True, order=order)
            .withColumns({c: F.col(f"{flt.SEQ}._doc.{c}") for c in order}).checkpoint(eager=True))
    bad = rows.where(F.col("date").isNull()).select("request_id").distinct().withColumn("bad", F.lit(True))
    points = rows.join(_shuffled(bad), "request_id", "left_anti").where(F.col("asin").isNotNull()).checkpoint(eager=True)
    counts = [_write_counts(points, read_live(points.sparkSession, target, SALES, SALES_TABLE), ups.SALES_KEYS, name)
              .checkpoint(eager=True) for name, target in _sides(targets)]
    failed_at, _, _ = _write_sales(points.drop("request_id"), targets, "adhoc", version, as_of)
    documents = payloads.document_summary(parsed).groupBy("request_id").agg(
        F.coalesce(F.max(F.when(F.col("outcome") != "ok", F.col("outcome"))), F.lit("ok")).alias("outcome"))
    total = rows.groupBy("request_id").agg(F.count(F.lit(1)).alias("total_records"))
    documents = (documents.join(_shuffled(total), "request_id", "left").join(_shuffled(bad), "request_id", "left")
                 .withColumn("outcome", F.when(F.col("bad"), "bad_point").otherwise(F.col("outcome"))).drop("bad"))
    return _answers(asked, documents, counts, failed_at).select(
        "request_id", "asin", "marketplace", "start_date", "end_date", "date_range_adjusted", "original_start_date", "outcome",
        F.coalesce("total_records", F.lit(0)).alias("total_records"), *COUNTS)
