"""The two scheduled runs, composed from the operators.

Incremental run: clean up the status table against the visible catalog,
add new keys, select at most 100 keys (new first, then stale), take the
landed product and sales documents for them, upsert products and sales,
mark not-found keys, fold all status changes in one pass, count API usage,
summarise, and publish (status to staging only).

Full run: reset the status of every visible key (mode ``fresh``) or keep it
(``resume``), process every key that needs product data in batches, then every
key that needs sales data over one fixed window, and publish (status to both
targets).

The landed documents stand in for the API calls: a run reads the documents
that were landed for its keys and that no earlier run has handled
(``sources/ledger.py``); ``fetch_errors`` names the keys whose request failed.

What happens to each key becomes status events, per target: a write that fails
on one target only changes that target's status, as it does in the reference.
``OUTCOMES`` states the events of each outcome for each run. Errors are rows
(kind, message) that give the summary its counts, samples and class.

Every step is a lazy plan; actions happen at the publish steps, at the
checkpoints of the run's bounded intermediate results (new documents, selection,
product rows, sales points, events), and in the bounded lookups (touched
partitions and buckets, event-key count, summary counts, a run's batch log).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.dates import ts_lit
from quayside.operators import batches as bat
from quayside.operators import flatten as flt
from quayside.operators import report, select as sel, status as st, upsert as ups
from quayside.operators.validate import split_valid_rows
from quayside.plans import windows
from quayside.schemas import SALES_REQUIRED, STATUS_TABLE, USAGE_TABLE
from quayside.session import ensure_checkpoint_dir
from quayside.sinks import call_log, run_log, sales_layout
from quayside.sinks.publish import RUN_TARGETS, Target, drop_folder, live_pointer, publish, read_live
from quayside.sources import ledger, payloads

PRODUCT_TABLE, SALES, STATUS, USAGE = "product_data", "sales_estimate_data", "sync_status", "api_usage"
# This engine's own wording.
NO_SALES_DOCUMENT = "No usable sales document landed"
NO_SALES_POINT = "No sales point stored"
TOO_MANY_FAILURES = "Too many batches in a row stored nothing"
WRITE_FAILED = "A write failed"
RETRY_DAYS = 15  # after which a key that was not found is asked for again (fixed value)
WAVE_BATCHES = 10_000  # batches of keys that a full run works on at a time
PRODUCT_REQUIRED = ["asin", "report_date", "id"]
FETCH_ERRORS = "source string, asin string, error_text string"

# Status events by what happened to a key: (event, target). Targets are those of the status table, which the
# incremental run keeps on staging only. No entry: the status stays as it is.
OUTCOMES = {
    "incremental": {
        "product_ok": [("product_stored", "staging")],
        "product_staging_failed": [("product_store_failed", "staging")],
        "product_production_failed": [("product_stored", "staging")],
        "product_not_found": [("product_not_found", "staging")],
        "sales_ok": [("sales_stored", "staging")],
        "sales_fetch_failed": [("sales_fetch_failed", "staging")],
    },
    "full": {
        "product_ok": [("product_stored", "both")],
        "product_staging_failed": [("product_store_failed", "staging")],
        "product_production_failed": [("product_stored", "staging"), ("product_store_failed", "production")],
        "product_batch_failed": [("batch_fetch_failed", "both")],
        "sales_ok": [("sales_stored", "both")],
        "sales_fetch_failed": [("sales_fetch_failed", "both")],
        "sales_staging_failed": [("sales_fetch_failed", "both")],
        "sales_production_failed": [("sales_fetch_failed", "both")],
        "sales_no_point": [("sales_all_failed", "both")],
    },
}


@dataclass(frozen=True)
class RunTargets:
    staging: Target
    production: Target
    sales_buckets: int = sales_layout.BUCKETS


def _publish_table(df: DataFrame, name: str, version: str, targets: RunTargets, mode: str,
                   partition_by: str | None = None, merge_partitions: bool = False,
                   on_error: str = "raise", replaced: set[str] | None = None, once: bool = False,
                   added: bool = False) -> DataFrame:
    where = RUN_TARGETS[mode][name]
    prod = targets.production if "production" in where else None
    return publish(df, name, version, targets.staging, prod, partition_by=partition_by,
                   merge_partitions=merge_partitions, on_error=on_error, replaced=replaced, once=once,
                   added=added)


REJECTS = "run_rejects"
SALES_NOT_NULL = list(SALES_REQUIRED) + ["estimated_units_sold", "last_known_price"]


def _ordered(parsed: DataFrame) -> list[str]:
    order = [c for c in flt.document_order(parsed) if c != ledger.KEY]
    if not order:
        raise ValueError("documents need columns that give their order (for example file and line), for last-wins rows")
    return order


def _stored_products(parsed: DataFrame, keys: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Flat product rows (code path) of the landed documents, for ``keys`` only, with their order."""
    rows = flt.flatten_products(payloads.good_documents(parsed), as_of.date(), as_of, defaults="zero",
                                asin_rule="code", order=_ordered(parsed))
    return rows.join(keys.select("asin"), "asin", "left_semi")


def _sales_rows(parsed: DataFrame, keys: DataFrame, marketplace: str, strict: bool) -> tuple[DataFrame, DataFrame]:
    """Flat sales rows of ``keys``, split into writable rows and rows a NOT
    NULL column rejects (SNK-4: the hourly run records them and goes on, the
    strict full run raises)."""
    rows = flt.flatten_sales(payloads.good_documents(parsed), marketplace=marketplace, first_item_only=True,
                             order=_ordered(parsed))
    return split_valid_rows(rows.join(keys.select("asin"), "asin", "left_semi"), SALES_NOT_NULL, strict=strict)


def _rejects(products: DataFrame, sales: DataFrame, points: DataFrame, version: str) -> DataFrame:
    """What the run could not store: documents that did not decode or held no item, and rejected points."""
    parts = []
    for source, parsed in (("product", products), ("sales", sales)):
        bad, empty = payloads.quarantine(parsed), payloads.empty_documents(parsed)
        parts += [bad.select(F.lit(source).alias("source"), F.lit(None).cast("string").alias("asin"), "reason",
                             F.col("raw").alias("detail")),
                  empty.select(F.lit(source).alias("source"), F.lit(None).cast("string").alias("asin"), "reason",
                               F.lit(None).cast("string").alias("detail"))]
    parts.append(points.select(F.lit("sales_point").alias("source"), "asin", F.col("reject_reason").alias("reason"),
                               F.to_json(F.struct("marketplace", "date", "estimated_units_sold")).alias("detail")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("run", F.lit(version))


def _publish_rejects(rejects: DataFrame, version: str, targets: RunTargets, mode: str) -> None:
    """One partition per run; a repeated run replaces its own. The folder's name is a word that no run id, whatever
    its characters, can break, and that reads back as text."""
    part = f"run-{uuid.uuid5(uuid.NAMESPACE_URL, version).hex}"
    _publish_table(rejects.withColumn("part", F.lit(part)), REJECTS, version, targets, mode, partition_by="part",
                   merge_partitions=True, replaced={part})


def _publish_status(status_new: DataFrame, touched_keys: DataFrame | None, target: Target, version: str,
                    buckets: int | None = None, on_error: str = "raise") -> DataFrame:
    """Publish one target's status table, partitioned by key bucket.

    When the live table already has a bucket layout and ``touched_keys`` is
    given, only the buckets holding those keys are rewritten, with the live
    bucket count (an hourly run touches a few hundred keys). Otherwise the
    whole table is written once; the bucket count is ``buckets`` or is chosen
    from the row count (about a million keys per bucket folder)."""
    import re

    spark = status_new.sparkSession
    live = live_pointer(spark, target, STATUS)
    rows = live.collect() if live is not None else []  # at most one row per bucket
    counts = {m.group(1) for m in (re.search(r"/bucket_(\d+)=", r.table_name) for r in rows) if m}
    live_buckets = int(counts.pop()) if len(counts) == 1 and all("/bucket_" in r.table_name for r in rows) else None
    merge = touched_keys is not None and live_buckets is not None
    if merge:
        buckets = live_buckets
    elif buckets is None:
        buckets = st.choose_buckets(status_new.count())
    col = st.bucket_column(buckets)
    out = status_new.withColumn(col, st.status_bucket(F.col("asin"), buckets))
    replaced = None
    if merge:
        touched = touched_keys.select(st.status_bucket(F.col("asin"), buckets).alias("b")).distinct()
        values = [r.b for r in touched.collect()]  # at most ``buckets`` values
        out = out.filter(F.col(col).isin(values))
        # A touched bucket that ends empty must not keep its old folder.
        replaced = {str(v) for v in values}
    return publish(out, STATUS, version, target, partition_by=col, merge_partitions=merge, replaced=replaced,
                   on_error=on_error)


def _events(keys: DataFrame, kind: str, as_of: dt.datetime, seq: int, target: str, text: str | None = None) -> DataFrame:
    """One event per key; the keys' own ``error_text``, where they have one, comes before ``text``."""
    own = F.coalesce("error_text", F.lit(text)) if "error_text" in keys.columns else F.lit(text)
    return keys.select("asin", F.lit(seq).cast("bigint").alias("seq"), F.lit(kind).alias("kind"),
                       ts_lit(as_of).alias("at"), own.cast("string").alias("error_text"), F.lit(target).alias("target"))


def outcome_events(mode: str, outcome: str, keys: DataFrame, as_of: dt.datetime, seq: int,
                   text: str | None = None) -> list[DataFrame]:
    """The status events of one outcome, by ``OUTCOMES``."""
    return [_events(keys, kind, as_of, seq, target, text) for kind, target in OUTCOMES[mode].get(outcome, [])]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _errors(rows: DataFrame, run: str, seq: int, kind: str, message) -> DataFrame:
    return rows.select(F.lit(run).alias("run_id"), F.lit(seq).cast("bigint").alias("seq"), F.lit(kind).alias("error_kind"),
                       (F.lit(message) if isinstance(message, str) else message).alias("message"))


def _failed_write(report_rows: DataFrame, targets: RunTargets) -> tuple[str | None, str | None]:
    """(target, error) of a publish report: the target whose write failed, if any."""
    for r in report_rows.collect():  # one row per target
        if r.status == "failed":
            return ("staging" if r.target == targets.staging.prefix else "production"), r.error
    return None, None


def _write_sales(points: DataFrame, targets: RunTargets, mode: str, version: str,
                 as_of: dt.datetime) -> tuple[str | None, str | None, tuple[int, int]]:
    """Merge the run's (checkpointed) points into both targets: (target that failed, its error, rows inserted and
    updated). Only the folders of the run's keys and months are read and written; without points nothing is."""
    if points.isEmpty():
        return None, None, (0, 0)
    live, dealt, by_folder = sales_layout.merge_input(points.sparkSession, [targets.staging, targets.production], SALES,
                                                      points, targets.sales_buckets)
    merged, counts = ups.observed_counts(ups.upsert_sales(live, dealt, as_of, seq=flt.SEQ))
    failed_at, why = _failed_write(
        _publish_table(merged, SALES, version, targets, mode, partition_by=sales_layout.PART, merge_partitions=by_folder,
                       on_error="log"), targets)
    return failed_at, why, _written(counts, failed_at)


def _new_documents(docs: DataFrame, log: run_log.RunLog, source: str, version: str) -> DataFrame:
    """Parsed documents that no earlier run has handled; checkpointed, since every later step reads them."""
    read = payloads.read_product_payloads if source == "product" else payloads.read_sales_payloads
    return read(ledger.unhandled(docs, log, source, version)).checkpoint(eager=True)


def _answered(sdocs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys with a sales item, and keys whose response held none. A response without items names no key;
    it is told apart where the documents carry the key they were asked for (column ``asin``)."""
    items = (payloads.good_documents(sdocs).select(F.get("data", 0)["attributes"]["asin"].alias("asin")).distinct()
             .join(keys.select("asin"), "asin", "left_semi"))
    if "asin" not in sdocs.columns:
        return items, items.limit(0)
    empty = payloads.empty_documents(sdocs).select("asin").distinct().join(keys.select("asin"), "asin", "left_semi")
    return items, empty.join(items, "asin", "left_anti")


def _document_errors(rejects: DataFrame, version: str) -> list[DataFrame]:
    """A document that does not decode is a parse error, one without items an API error, a rejected point a
    database error."""
    text = F.concat_ws(": ", "source", "asin", "reason", F.when(F.col("source") == "product_row", F.col("detail")))
    return [_errors(rejects.where("reason = 'parse_error'"), version, 6, "parse", text),
            _errors(rejects.where("reason = 'empty_response'"), version, 6, "api", text),
            _errors(rejects.where("source IN ('sales_point', 'product_row')"), version, 6, "db", text)]


def _counts(parts: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts by name, in one job."""
    one = [df.agg(F.count(F.lit(1)).alias("v")).select(F.lit(k).alias("k"), "v") for k, df in parts.items()]
    return {r.k: r.v for r in _union(one).collect()}


def _fetch_failures(spark: SparkSession, fetch_errors: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(asin, error_text) of failed product and sales requests, one row per key."""
    rows = fetch_errors if fetch_errors is not None else spark.createDataFrame([], FETCH_ERRORS)
    one = rows.groupBy("source", "asin").agg(F.max("error_text").alias("error_text"))
    return tuple(one.where(F.col("source") == s).select("asin", "error_text") for s in ("product", "sales"))


def incremental_run(spark: SparkSession, catalog: DataFrame, product_docs: DataFrame, sales_docs: DataFrame,
                    calls: DataFrame, targets: RunTargets, as_of: dt.datetime, version: str,
                    marketplace: str = "us", limit: int = sel.RUN_KEY_LIMIT,
                    status_buckets: int | None = None, fetch_errors: DataFrame | None = None) -> DataFrame:
    """One incremental run; returns its one-row summary.

    ``fetch_errors`` (source ``product`` or ``sales``, asin, error_text) names
    keys whose request failed. A failed product request leaves the status of
    its keys alone; a failed sales request is noted on the key."""
    ensure_checkpoint_dir(spark)
    status0 = read_live(spark, targets.staging, STATUS, STATUS_TABLE)
    visible = sel.visible_asins(catalog)
    kept = sel.cleanup_kept(status0, visible)
    removed = sel.cleanup_deleted(status0, visible).select("asin")
    added = sel.add_new_keys(visible, kept, as_of)
    status1 = kept.unionByName(added)
    log = run_log.handled_log(spark, targets.staging)

    # The selection (at most ``limit`` rows) is used four times; it is
    # checkpointed to the shared folder so every use sees the same keys.
    selection = sel.select_priority(status1, as_of, limit).checkpoint(eager=True)
    pdocs = _new_documents(product_docs, log, "product", version)
    sdocs = _new_documents(sales_docs, log, "sales", version)
    no_product, no_sales = _fetch_failures(spark, fetch_errors)
    no_product = no_product.join(selection.select("asin"), "asin", "left_semi")
    # Rows of the run's keys only (bounded by the run size), parsed once.
    products = _stored_products(pdocs, selection, as_of).checkpoint(eager=True)
    returned = products.select("asin").distinct()
    missing = sel.not_found(selection, products).join(no_product, "asin", "left_anti")

    # Products: staging then production; the snapshot table is partitioned
    # by report_date, and only today's partition is rewritten.
    prod_live = read_live(spark, targets.staging, PRODUCT_TABLE, products.drop(flt.SEQ).schema)
    merged, product_counts = ups.observed_counts(
        ups.upsert_products(prod_live, products, as_of, partition_by=["report_date"], seq=flt.SEQ, touched_only=True))
    failed_at, why = _failed_write(
        _publish_table(merged, PRODUCT_TABLE, version, targets, "incremental", partition_by="report_date",
                       merge_partitions=True, on_error="log"), targets)
    outcome = f"product_{failed_at}_failed" if failed_at else "product_ok"
    # Only keys stored on both targets go on to sales.
    stored = returned.limit(0) if failed_at else returned
    events = (outcome_events("incremental", outcome, returned, as_of, 1, why)
              + outcome_events("incremental", "product_not_found", missing, as_of, 1))
    n_missing = missing.agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    errors = [_errors(no_product.select("error_text").distinct(), version, 1, "api",
                      F.concat(F.lit("Product request failed: "), F.col("error_text"))),
              _errors(n_missing, version, 2, "api",
                      F.concat(F.col("n").cast("string"), F.lit(f" keys not found (asked again in {RETRY_DAYS} days)")))]
    if failed_at:
        errors.append(_errors(returned, version, 1, "db",
                              F.concat(F.lit(f"Product write to {failed_at} failed for "), "asin", F.lit(f": {why}"))))

    # Sales for stored keys, over each key's window (yesterday back to the
    # last sync, or one year for never-synced keys).
    no_sales = no_sales.join(stored, "asin", "left_semi")
    asked = stored.join(no_sales, "asin", "left_anti")
    win = windows.plan_sales_windows(sel.attach_sync_info(selection, asked), as_of)
    good_points, rejected_points = _sales_rows(sdocs, asked, marketplace, strict=False)
    points = (good_points.join(win, "asin")
              .filter(F.col("date").between(F.col("start_date"), F.col("end_date")))
              .drop("start_date", "end_date", "is_empty_window")
              .checkpoint(eager=True))  # the run's keys only; reused three times
    sales_failed_at, sales_why, sales_counts = _write_sales(points, targets, "incremental", version, as_of)
    stopped = sales_failed_at is not None
    with_sales = points.select("asin").distinct()
    with_sales = with_sales.limit(0) if stopped else with_sales
    with_item, empty = _answered(sdocs, asked)
    # No document landed for these: their request failed. Keys with an item but no stored point, and keys whose
    # response was empty, keep their status.
    unanswered = asked.join(with_item, "asin", "left_anti").join(empty, "asin", "left_anti")
    failed_sales = no_sales.unionByName(unanswered.withColumn("error_text", F.lit(NO_SALES_DOCUMENT)))
    events += (outcome_events("incremental", "sales_ok", with_sales, as_of, 2)
               + outcome_events("incremental", "sales_fetch_failed", failed_sales, as_of, 2))
    errors.append(_errors(failed_sales, version, 3, "api", F.concat(F.lit("Sales request failed for "), "asin",
                                                                     F.lit(": "), "error_text")))
    if stopped:
        errors.append(_errors(spark.range(1), version, 4, "db", f"Sales write to {sales_failed_at} failed: {sales_why}"))
    rejects = _rejects(pdocs, sdocs, rejected_points, version).checkpoint(eager=True)
    _publish_rejects(rejects, version, targets, "incremental")
    errors += _document_errors(rejects, version)

    # Status: one fold over the run's events, staging only. They are checkpointed once: the fold's key filter, the
    # touched buckets and the fold itself all read them.
    folded = _union([_events(removed, "key_removed", as_of, 0, "staging"), *events]).checkpoint(eager=True)
    status2 = st.fold_status(status1, run_log.of_target(folded.withColumn("run", F.lit(version)), "staging"))
    touched = folded.select("asin").unionByName(added.select("asin"))
    _publish_status(status2, touched, targets.staging, version, status_buckets)
    _publish_usage(spark, calls, targets, "incremental", version)
    # Last, so that a run that stopped before this point deals with its documents again.
    log.put(ledger.handled(pdocs, selection, "product", version)
            .unionByName(ledger.handled(sdocs, selection, "sales", version)), version, "documents")

    # Summary (RPT ops): every count in one job (a union of one-row counts).
    row = _counts({"new_asins": selection.where("is_new"), "stale_asins": selection.where("NOT is_new"),
                   "total_asins": selection, "product_ok": stored, "sales_ok": with_sales, "calls": calls,
                   "cleaned_up": removed, "added": added, "rejected_points": rejects.filter("source = 'sales_point'"),
                   "rejected_documents": rejects.filter("source <> 'sales_point'")})
    digest = _hourly_errors(_union(errors), version)
    processed = row["total_asins"]
    failed = processed - row["product_ok"]
    out = spark.createDataFrame([(version, processed, row["new_asins"], row["stale_asins"], row["product_ok"],
                                  failed, row["sales_ok"], row["calls"], row["cleaned_up"], row["added"],
                                  row["rejected_points"], row["rejected_documents"],
                                  row["product_ok"] - row["sales_ok"], *digest, stopped,
                                  *_written(product_counts, failed_at), *sales_counts)],
                                "version string, processed long, new_asins long, stale_asins long, product_ok long, "
                                "failed long, sales_ok long, calls long, cleaned_up long, added long, "
                                "rejected_points long, rejected_documents long, sales_failed long, db_errors long, "
                                "api_errors long, parse_errors long, other_errors long, sample_text string, stopped boolean, "
                                "products_inserted long, products_updated long, sales_inserted long, sales_updated long")
    total = F.col("db_errors") + F.col("api_errors") + F.col("parse_errors") + F.col("other_errors")
    return out.select("*", report.run_class_hourly(F.col("stopped"), F.col("failed"), total).alias("run_class"),
                      report.run_verdict(F.col("stopped"), F.col("failed"), F.col("product_ok")).alias("verdict"))


def _written(counts: Observation, failed_at: str | None) -> tuple[int, int]:
    """Inserted and updated rows of a publish on staging, counted by its write; none if that failed."""
    return (0, 0) if failed_at == "staging" else (counts.get["inserted"], counts.get["updated"])


def _hourly_errors(errors: DataFrame, run: str) -> tuple:
    """Counts by kind and the digest of the first messages (AGG-12, RPT-4) of one run."""
    summary = report.error_summary(errors)
    r = summary.join(report.error_digest_hourly(summary), "run_id").first()
    return (r.db_errors, r.api_errors, r.parse_errors, r.other_errors, r.sample_text) if r else (0, 0, 0, 0, "")


def _publish_usage(spark: SparkSession, calls: DataFrame, targets: RunTargets, mode: str, version: str) -> None:
    """Log the run's calls, each once, and count their days again; a repeated run adds nothing (SNK-3: errors are
    logged, not raised)."""
    path = f"{targets.staging.table(USAGE)}_log"
    days = call_log.append_calls(spark, calls, path)
    if days:
        merged = call_log.counted_usage(spark, read_live(spark, targets.staging, USAGE, USAGE_TABLE), path, days)
        _publish_table(merged, USAGE, version, targets, mode, on_error="log")


def batch_outcomes(run: str, keys: DataFrame, returned: DataFrame, stored: DataFrame, failed: DataFrame) -> DataFrame:
    """One row per batch of ``keys`` (asin, batch_no): how many keys it asked for, got and stored, and whether its
    request failed. The other tables name keys."""
    def mark(df, name):
        return df.select("asin").distinct().withColumn(name, F.lit(1))
    marked = (keys.join(mark(returned, "_returned"), "asin", "left").join(mark(stored, "_stored"), "asin", "left")
              .join(mark(failed, "_failed"), "asin", "left"))
    return marked.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("requested"), F.count("_returned").alias("returned"), F.count("_stored").alias("stored"),
        (F.count("_failed") > 0).alias("fetch_failed")).withColumn("run_id", F.lit(run))


@dataclass
class _ProductStep:
    """What the product step of a full run did."""
    events: DataFrame
    batches: DataFrame
    errors: list[DataFrame]
    rejected: DataFrame
    stop_reason: str | None


def _rows_by_wave(todo: DataFrame, pdocs: DataFrame, no_batch: DataFrame, as_of: dt.datetime, done: int,
                  wave_batches: int) -> tuple[str, T.StructType]:
    """The product rows of the batches behind ``done``, staged in one pass over the documents, one folder
    (``_wave=<number>``) per wave, so that a wave reads its own rows only. Returns the folder and its schema."""
    wave = F.floor((F.col("batch_no") - (done + 1)) / wave_batches).cast("int").alias("_wave")
    asked = todo.where(F.col("batch_no") > done).join(no_batch, "batch_no", "left_anti")
    rows = flt.flatten_products(payloads.good_documents(pdocs), as_of.date(), as_of, defaults="zero", asin_rule="code",
                                order=_ordered(pdocs))
    path = f"{ensure_checkpoint_dir(todo.sparkSession).rstrip('/')}/products-{uuid.uuid4().hex[:12]}"
    rows.join(asked.select("asin", wave).distinct(), "asin").write.partitionBy("_wave").parquet(path)
    return path, T.StructType([*rows.schema.fields, T.StructField("_wave", T.IntegerType())])


def _new_keys_only(rows: DataFrame, lives: list[DataFrame], as_of: dt.datetime) -> bool:
    """Whether none of the targets holds a key of ``rows`` for the run's day, and they hold equally many rows of that
    day: then adding the rows gives what merging them would. Only keys within the range of the rows' keys are read."""
    lives = [live.where(F.col("report_date") == F.lit(as_of.date())) for live in lives]
    if len({live.count() for live in lives}) > 1:
        return False
    ends = rows.agg(F.min("asin").alias("low"), F.max("asin").alias("high")).first()
    if ends.low is None:
        return True
    keys = rows.select("asin").distinct()
    return all(live.where(F.col("asin").between(ends.low, ends.high)).select("asin").join(keys, "asin", "left_semi").isEmpty()
               for live in lives)


def _sync_products(spark: SparkSession, todo: DataFrame, pdocs: DataFrame, no_product: DataFrame, targets: RunTargets,
                   as_of: dt.datetime, version: str, wave_batches: int, required: list[str]) -> _ProductStep:
    """The batches of ``todo`` (asin, batch_no), ``wave_batches`` at a time.

    A wave's batches are judged in one job; the run stops at the third batch in
    a row that got rows and stored none (WIN-3), across waves too. Batches up
    to there are written, then the wave's events and, as its commit, its
    batches are logged: a run that is repeated after a crash goes on behind the
    last logged batch, and has the events and rejected rows of those before. A wave whose write failed is not logged as done."""
    batches, log = run_log.batch_log(spark, targets.staging), run_log.event_log(spark, targets.staging)
    rejects = run_log.reject_log(spark, targets.staging)
    last = todo.agg(F.max("batch_no")).first()[0] or 0
    done = batches.read(version).agg(F.max("batch_no")).first()[0] or 0
    stop = bat.stop_point(batches.read(version)).first()
    if stop is not None and stop.stop_batch is not None:
        done = last  # an earlier attempt has stopped; so has this one
    errors, stop_reason, unwritten = [], None, None
    no_batch = (no_product.join(todo, "asin").groupBy("batch_no").agg(F.max("error_text").alias("error_text"))
                .checkpoint(eager=True))
    if done < last:
        staged, schema = _rows_by_wave(todo, pdocs, no_batch, as_of, done, wave_batches)
    for number, low in enumerate(range(done + 1, last + 1, wave_batches)):
        wave = todo.where(F.col("batch_no").between(low, low + wave_batches - 1)).checkpoint(eager=True)
        failed = wave.join(no_batch, "batch_no")
        rows = spark.read.schema(schema).parquet(staged).where(F.col("_wave") == number).drop("_wave")
        good, rejected = split_valid_rows(rows, required)
        judged = batch_outcomes(version, wave, rows, good, failed).checkpoint(eager=True)
        stop = bat.stop_point(batches.read(version).unionByName(judged)).first()  # one row: this run
        upto = wave if stop.stop_batch is None else wave.where(F.col("batch_no") <= stop.stop_batch)
        stored = good.join(upto.select("asin"), "asin", "left_semi")
        table = rows.drop(flt.SEQ).schema
        lives = [read_live(spark, t, PRODUCT_TABLE, table) for t in (targets.staging, targets.production)]
        # A wave of new keys is a folder of its own: the day's rows of the waves before are not written again.
        added = _new_keys_only(stored, lives, as_of)
        merged = (ups.upsert_products(spark.createDataFrame([], table), stored, as_of, seq=flt.SEQ) if added else
                  ups.upsert_products(lives[0], stored, as_of, partition_by=["report_date"], seq=flt.SEQ, touched_only=True))
        failed_at, why = _failed_write(
            _publish_table(merged.drop("action"), PRODUCT_TABLE, version, targets, "full", partition_by="report_date",
                           merge_partitions=True, on_error="log", added=added), targets)
        outcome = f"product_{failed_at}_failed" if failed_at else "product_ok"
        failed = failed.join(upto.select("asin"), "asin", "left_semi")
        events = _union(outcome_events("full", outcome, stored.select("asin").distinct(), as_of, 1, why)
                        + outcome_events("full", "product_batch_failed", failed, as_of, 1))
        log.put(events.withColumn("run", F.lit(version)), version, f"{low:09d}")
        rejects.put(rejected.join(upto.select("asin"), "asin", "left_semi").select(
            F.lit("product_row").alias("source"), "asin", F.col("reject_reason").alias("reason"), F.col("id").alias("detail"),
            F.lit(version).alias("run")), version, f"{low:09d}")
        if failed_at:
            unwritten = judged.withColumn("stored", F.lit(0).cast("bigint"))
            stop_reason = f"{WRITE_FAILED}: products to {failed_at}: {why}"
            errors.append(_errors(spark.range(1), version, low, "db", stop_reason))
            break
        # What lies behind the stop was never asked for.
        batches.put(judged.join(upto.select("batch_no").distinct(), "batch_no", "left_semi"), version, f"{low:09d}")
        if stop.stop_batch is not None:
            break
    if done < last:
        drop_folder(spark, staged)
    worked = batches.read(version)
    stop = bat.stop_point(worked).first()
    if stop is not None and stop.stop_batch is not None:
        stop_reason = f"{TOO_MANY_FAILURES} (batch {stop.stop_batch} of {last})"
        errors.append(_errors(spark.range(1), version, stop.stop_batch, "db", stop_reason))
    worked = worked if unwritten is None else worked.unionByName(unwritten)
    errors.append(_errors(no_batch.join(worked, "batch_no", "left_semi"), version, 0, "api",
                          F.concat(F.lit("Batch "), F.col("batch_no").cast("string"), F.lit(": product request failed: "),
                                   F.col("error_text"))))
    return _ProductStep(log.read(version), worked, errors, rejects.read(version), stop_reason)


def full_run(spark: SparkSession, catalog: DataFrame, product_docs: DataFrame, sales_docs: DataFrame,
             targets: RunTargets, as_of: dt.datetime, version: str, sync_mode: str = "fresh",
             date_range: str = "1month", marketplace: str = "us", status_buckets: int | None = None,
             calls: DataFrame | None = None, strict: bool = True, fetch_errors: DataFrame | None = None,
             wave_batches: int = WAVE_BATCHES, batch_size: int = bat.BATCH_SIZE,
             product_required: list[str] | None = None) -> DataFrame:
    """One full run; returns its one-row summary. A point that a NOT NULL
    column rejects stops a ``strict`` run before sales are written; otherwise
    it is recorded, as in the hourly run. ``calls`` is the run's call log and
    ``fetch_errors`` as in :func:`incremental_run`; here a failed product
    request fails its whole batch. Keys that a batch did not return keep their
    status. A product row must hold ``product_required``."""
    ensure_checkpoint_dir(spark)
    sync_mode = windows.check_request_args(1, sync_mode, date_range)
    visible = sel.visible_asins(catalog)
    log = run_log.handled_log(spark, targets.staging)
    pdocs = _new_documents(product_docs, log, "product", version)
    sdocs = _new_documents(sales_docs, log, "sales", version)
    no_product, no_sales = _fetch_failures(spark, fetch_errors)

    def base(target: Target) -> DataFrame:
        """The target's status before the run; production starts as a copy of staging's."""
        known = target if live_pointer(spark, target, STATUS) is not None else targets.staging
        table = read_live(spark, known, STATUS, STATUS_TABLE)
        return st.fold_status(table, st.fresh_reset_events(visible, as_of)) if sync_mode == "fresh" else table

    # Checkpointed: the batches, the sales step and the status tables written last all start from them.
    status1 = base(targets.staging).checkpoint(eager=True)
    apart = live_pointer(spark, targets.production, STATUS) is not None
    bases = {"staging": status1, "production": base(targets.production).checkpoint(eager=True) if apart else status1}
    # The same batches for a repeated run: the status is published at its end.
    todo = bat.plan_batches(sel.needs_product(status1), batch_size=batch_size).select("asin", "batch_no").checkpoint(eager=True)
    step = _sync_products(spark, todo, pdocs, no_product, targets, as_of, version, wave_batches,
                          product_required or PRODUCT_REQUIRED)
    events, errors = [step.events.drop("run")], step.errors
    stop_reason = step.stop_reason

    # The sales step takes every key with product data and without sales,
    # also keys whose products an earlier run stored (mode resume). A run that has stopped asks for none.
    todo_sales = sel.needs_sales(st.fold_status(status1, run_log.of_target(step.events, "staging"))).select("asin")
    todo_sales = (todo_sales.limit(0) if stop_reason else todo_sales).checkpoint(eager=True)
    no_sales = no_sales.join(todo_sales, "asin", "left_semi")
    asked = todo_sales.join(no_sales, "asin", "left_anti")
    good_points, rejected_points = _sales_rows(sdocs, asked, marketplace, strict=strict)
    window = windows.plan_fixed_window(asked, as_of, date_range)
    points = (good_points.join(window, "asin")
              .filter(F.col("date").between(F.col("start_date"), F.col("end_date")))
              .drop("start_date", "end_date", "date_range")
              .checkpoint(eager=True))
    failed_at, why, _ = _write_sales(points, targets, "full", version, as_of)
    written = points.select("asin").distinct()
    with_sales = written.limit(0) if failed_at else written
    with_item, empty = _answered(sdocs, asked)
    unanswered = asked.join(with_item, "asin", "left_anti").join(empty, "asin", "left_anti")
    failed_sales = no_sales.unionByName(unanswered.withColumn("error_text", F.lit(NO_SALES_DOCUMENT)))
    no_point = with_item.join(written, "asin", "left_anti")
    outcome = f"sales_{failed_at}_failed" if failed_at else "sales_ok"
    if failed_at:
        stop_reason = f"{WRITE_FAILED}: sales to {failed_at}: {why}"
        errors.append(_errors(spark.range(1), version, 2**40, "db", stop_reason))
    events += (outcome_events("full", outcome, written, as_of, 2, stop_reason)
               + outcome_events("full", "sales_fetch_failed", failed_sales, as_of, 2)
               + outcome_events("full", "sales_no_point", no_point, as_of, 2, NO_SALES_POINT))
    rejects = _union([_rejects(pdocs, sdocs, rejected_points, version), step.rejected]).checkpoint(eager=True)
    _publish_rejects(rejects, version, targets, "full")
    errors += _document_errors(rejects, version)

    folded = _union(events).checkpoint(eager=True).withColumn("run", F.lit(version))
    # At most the stored keys and the catalog's: no need to count the folded tables.
    buckets = status_buckets or st.choose_buckets(
        read_live(spark, targets.staging, STATUS, STATUS_TABLE).count() + catalog.count())
    for target, name in ((targets.staging, "staging"), (targets.production, "production")):
        # Staging must succeed; production's status is written last and its failure is logged, as each key's is.
        _publish_status(st.fold_status(bases[name], run_log.of_target(folded, name)), None, target, version,
                        buckets, on_error="raise" if name == "staging" else "log")
    if calls is not None:
        _publish_usage(spark, calls, targets, "full", version)
    log.put(ledger.handled(pdocs, todo, "product", version)
            .unionByName(ledger.handled(sdocs, todo_sales, "sales", version)), version, "documents")

    # Totals of the batches that were worked off: those before the stop, and not those whose request failed.
    stops = bat.stop_point(step.batches)
    of = (step.batches.join(stops, "run_id").where("stop_batch IS NULL OR batch_no < stop_batch").agg(
        F.sum(F.when(~F.col("fetch_failed"), F.col("requested"))).alias("processed"),
        F.sum(F.when(~F.col("fetch_failed"), F.col("stored"))).alias("stored")).first())
    done, ok = of.processed or 0, of.stored or 0
    total = todo.agg(F.max("batch_no")).first()[0] or 0
    stop_at = (stops.first() or {"stop_batch": None})["stop_batch"]
    reached = stop_at or step.batches.agg(F.max("batch_no")).first()[0] or 0
    # RPT-10: a run that stops has announced the batch after the one that stopped it.
    current = min(reached + 1, total) if step.stop_reason else reached
    row = _counts({"sales_todo": todo_sales, "sales_ok": with_sales,
                   "rejected_points": rejects.filter("source = 'sales_point'"),
                   "rejected_documents": rejects.filter("source IN ('product', 'sales')")})
    text = report.error_digest_full(_union(errors)).first() if errors else None
    failed = done - ok + row["sales_todo"] - row["sales_ok"]
    out = spark.createDataFrame([(version, done, ok, row["sales_todo"], row["sales_ok"], failed,
                                  row["rejected_points"], row["rejected_documents"], current, total,
                                  text.n_errors if text else 0, text.error_text if text else "",
                                  stop_reason is not None, stop_reason or "")],
                                "version string, processed long, product_ok long, sales_todo long, sales_ok long, "
                                "failed long, rejected_points long, rejected_documents long, current_batch long, "
                                "total_batches long, n_errors long, error_text string, stopped boolean, reason string")
    return out.select("*", report.run_class_full(F.col("stopped"), F.col("failed")).alias("run_class"),
                      report.stop_reason("full", F.col("stopped"), F.col("reason")).alias("stop_reason")).drop("reason")
