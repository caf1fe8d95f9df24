"""Run summaries: counts, totals, classes, error digests (AGG-11..13, RPT-1..9).

Per-run samples ("first k messages in arrival order") use
``row_number() <= k`` over a run window: Spark plans it with a
``WindowGroupLimit`` before the shuffle, so at most k rows per run and input
partition move, and the final ``collect_list`` holds at most k items. No run's
full error list is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ERROR_KINDS = ("db", "api", "parse")  # anything else counts as "other"
SAMPLE_ERRORS = 3      # samples kept in the incremental run's summary
DIGEST_ERRORS = 5      # errors listed in the full run's digest
DIGEST_BYTES = 500     # incremental digest cut, in bytes of UTF-8
RUN_KEYS_PER_CALL = 100
# Stop reasons of the reference's runs.
DEFAULT_STOP_REASON = "Critical errors encountered"     # full run, stopped with no reason given
SELECTION_FAILED_REASON = "Failed to select ASINs"      # incremental run, selection query failed


def selection_counts(selection: DataFrame) -> DataFrame:
    """AGG-11: new vs stale keys of a selection."""
    return selection.agg(F.count_if(F.col("is_new")).alias("new_asins"),
                         F.count_if(~F.col("is_new")).alias("stale_asins"),
                         F.count(F.lit(1)).alias("total_asins"))


def first_messages(outcomes: DataFrame, k: int, run: str = "run_id") -> DataFrame:
    """The first ``k`` messages per run by ``seq`` as an array."""
    w = Window.partitionBy(run).orderBy("seq")
    firsts = (outcomes.filter(F.col("message").isNotNull())
              .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k))
    return firsts.groupBy(run).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", "message"))), lambda x: x["message"])
        .alias("messages"))


def error_summary(outcomes: DataFrame, run: str = "run_id") -> DataFrame:
    """AGG-12: error counts by category and the first three messages."""
    kind = F.col("error_kind")
    counts = outcomes.groupBy(run).agg(
        F.count_if(kind == "db").alias("db_errors"), F.count_if(kind == "api").alias("api_errors"),
        F.count_if(kind == "parse").alias("parse_errors"),
        F.count_if(kind.isNotNull() & ~kind.isin(*ERROR_KINDS)).alias("other_errors"))
    samples = first_messages(outcomes, SAMPLE_ERRORS, run).withColumnRenamed("messages", "sample_errors")
    return (counts.join(samples, run, "left")
            .withColumn("sample_errors", F.coalesce("sample_errors", F.array().cast("array<string>"))))


def _calls(processed: Column, product_ok: Column) -> Column:
    return F.ceil(processed / RUN_KEYS_PER_CALL) + product_ok


def _outcome_counts(outcomes: DataFrame, run: str) -> DataFrame:
    """One aggregation per run feeding every total (and the error count the
    run class needs), so the outcome table is scanned and shuffled once."""
    return outcomes.groupBy(run).agg(
        F.count(F.lit(1)).alias("processed"), F.count_if("stored").alias("product_ok"),
        F.count_if(F.col("stored") & F.col("sales_ok")).alias("sales_ok"),
        F.count_if(F.col("stored") & ~F.col("sales_ok")).alias("_sales_failed"),
        F.count_if(F.col("error_kind").isNotNull()).alias("errors"))


def run_totals_hourly(outcomes: DataFrame, run: str = "run_id", with_errors: bool = False) -> DataFrame:
    """AGG-13 (incremental run): failed = selected - stored products; sales
    failures are not counted as failed keys. Calls: one product call per
    100 keys plus one sales call per stored product. RPT-8: the product
    ok / not-ok pair, not-ok = processed - ok."""
    t = _outcome_counts(outcomes, run)
    return t.select(run, "processed", "product_ok",
                    (F.col("processed") - F.col("product_ok")).alias("product_not_ok"), "sales_ok",
                    (F.col("processed") - F.col("product_ok")).alias("failed"),
                    _calls(F.col("processed"), F.col("product_ok")).cast("bigint").alias("calls"),
                    *(["errors"] if with_errors else []))


def run_totals_full(outcomes: DataFrame, run: str = "run_id", with_errors: bool = False) -> DataFrame:
    """AGG-13 (full run): failed = (batch - stored) plus sales failures of
    stored keys."""
    t = _outcome_counts(outcomes, run)
    return t.select(run, "processed", "product_ok", "sales_ok",
                    (F.col("processed") - F.col("product_ok") + F.col("_sales_failed")).alias("failed"),
                    _calls(F.col("processed"), F.col("product_ok")).cast("bigint").alias("calls"),
                    *(["errors"] if with_errors else []))


def run_class_hourly(stopped: Column, failed: Column, errors: Column) -> Column:
    """RPT-1: stopped -> red; failures or any error -> yellow; else green."""
    return F.when(stopped, "red").when((failed > 0) | (errors > 0), "yellow").otherwise("green")


def run_class_full(stopped: Column, failed: Column) -> Column:
    """RPT-2: stopped -> red; failures -> yellow (errors alone do not
    count); else green."""
    return F.when(stopped, "red").when(failed > 0, "yellow").otherwise("green")


def stop_reason(mode: str, stopped: Column, reason: Column | None = None,
                selection_failed: Column | None = None) -> Column:
    """RPT-6: the full run names a default reason when it stopped without
    one; the incremental run sets a reason only when its selection failed,
    else reports what it was given (blank by default)."""
    given = F.coalesce(reason, F.lit("")) if reason is not None else F.lit("")
    if mode == "full":
        return F.when(stopped & (given == ""), F.lit(DEFAULT_STOP_REASON)).otherwise(given)
    if selection_failed is not None:
        return F.when(selection_failed, F.lit(SELECTION_FAILED_REASON)).otherwise(given)
    return given


def run_progress(batch_log: DataFrame, stops: DataFrame, run: str = "run_id") -> DataFrame:
    """RPT-10: current batch / total batches of each run. A run that stops
    after batch b has already announced batch b + 1 (the stop is checked at
    the start of the next batch), capped at the total."""
    totals = batch_log.groupBy(run).agg(F.count(F.lit(1)).alias("total_batches"))
    current = F.when(F.col("stop_batch").isNull(), F.col("total_batches")).otherwise(
        F.least(F.col("stop_batch") + 1, F.col("total_batches")))
    return totals.join(stops, run, "left").select(run, current.cast("bigint").alias("current_batch"),
                                                  "total_batches")


def run_verdict(stopped: Column, failed: Column, product_ok: Column) -> Column:
    """RPT-5: exit verdict of the job."""
    return F.when(stopped | ((failed > 0) & (product_ok == 0)), "fail").otherwise("ok")


def error_digest_full(outcomes: DataFrame, run: str = "run_id") -> DataFrame:
    """RPT-3: first five messages, newline-joined, plus "... and n more
    errors" when there are more."""
    n = outcomes.filter(F.col("message").isNotNull()).groupBy(run).agg(F.count(F.lit(1)).alias("n_errors"))
    firsts = first_messages(outcomes, DIGEST_ERRORS, run)
    more = F.col("n_errors") - DIGEST_ERRORS
    text = F.concat(F.concat_ws("\n", "messages"),
                    F.when(more > 0, F.concat(F.lit("\n... and "), more.cast("string"), F.lit(" more errors")))
                    .otherwise(F.lit("")))
    return n.join(firsts, run).select(run, "n_errors", text.alias("error_text"))


def error_digest_hourly(summary: DataFrame, run: str = "run_id") -> DataFrame:
    """RPT-4: the samples newline-joined, cut at 500 bytes with ``...``. A
    character that the cut would split is left out, so the text stays valid."""
    s = F.concat_ws("\n", "sample_errors")
    raw = s.cast("binary")
    # Step back from the cut over later bytes of a character (10xxxxxx): at most three.
    start = F.coalesce(*[F.when(~F.hex(F.substring(raw, DIGEST_BYTES + 1 - k, 1)).rlike("^[89AB]"), F.lit(DIGEST_BYTES - k))
                         for k in range(4)], F.lit(DIGEST_BYTES))
    cut = F.decode(F.substring(raw, F.lit(1), start), "UTF-8")
    text = F.when(F.octet_length(s) > DIGEST_BYTES, F.concat(cut, F.lit("..."))).otherwise(s)
    return summary.select(run, text.alias("sample_text"))


def run_duration(started: Column, finished: Column) -> Column:
    """RPT-7: elapsed time rounded to whole seconds (half away from zero)."""
    us = F.timestamp_diff("MICROSECOND", started, finished)  # no time zone involved
    return F.when(us >= 0, F.floor((us + 500000) / 1000000)).otherwise(-F.floor((-us + 500000) / 1000000)) \
        .cast("bigint")
