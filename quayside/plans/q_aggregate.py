"""Aggregation, usage, planning and batch queries (AGG-1..9, UPS-5, PLN, WIN)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quayside.functions.dates import shift_date_sql
from quayside.operators import batches, sales, usage
from quayside.operators import select as sel
from quayside.plans import windows
from quayside.plans.q_select import _prio_sql
from quayside.plans.registry import query
from quayside.sources import standins as S
from quayside.sources.standins import AS_OF, with_views

# The call log covers 2024-01-01..2024-01-30; usage reports are run for its
# last day so that "today", "yesterday" and the look-backs all hold rows.
USAGE_DAY = dt.date(2024, 1, 30)
U_DAY = "DATE '2024-01-30'"

BILLABLE = "status = 200 AND n_items > 0"
USAGE_SQL = f"""SELECT CAST(ts AS DATE) AS usage_date, endpoint, count(*) AS call_count,
       min(ts) AS created_at, max(ts) AS updated_at
FROM v_calls WHERE {{where}} GROUP BY 1, 2"""


def _usage(spark, sf):
    return usage.usage_daily(S.calls(spark, sf))


@query("sales_summary", with_views("""
SELECT asin, count(*) AS days_count, min(date) AS start_date, max(date) AS end_date,
       CAST(sum(estimated_units_sold) AS BIGINT) AS total_units,
       round(sum(estimated_units_sold * last_known_price), 2) AS total_revenue
FROM v_sales GROUP BY asin""", "v_sales"))
def q_sales_summary(spark, sf):
    return sales.sales_summary(S.sales(spark, sf))


@query("usage_billable", with_views(f"SELECT * FROM v_calls WHERE {BILLABLE}", "v_calls"))
def q_usage_billable(spark, sf):
    return usage.billable_calls(S.calls(spark, sf), "code")


@query("usage_daily", with_views(USAGE_SQL.format(where=BILLABLE), "v_calls"))
def q_usage_daily(spark, sf):
    return _usage(spark, sf)


@query("usage_all_responses", with_views(USAGE_SQL.format(where="status IS NOT NULL"), "v_calls"))
def q_usage_all_responses(spark, sf):
    return usage.usage_daily(S.calls(spark, sf), "documented")


def _usage_view():
    return {"usage": USAGE_SQL.format(where=BILLABLE)}


@query("usage_today", with_views(f"SELECT endpoint, call_count, updated_at FROM usage WHERE usage_date = {U_DAY}",
                                 "v_calls", extra=_usage_view()))
def q_usage_today(spark, sf):
    return usage.usage_today(_usage(spark, sf), USAGE_DAY)


@query("usage_yesterday", with_views(f"SELECT endpoint, call_count FROM usage WHERE usage_date = {U_DAY} - 1",
                                     "v_calls", extra=_usage_view()))
def q_usage_yesterday(spark, sf):
    return usage.usage_yesterday(_usage(spark, sf), USAGE_DAY)


@query("usage_7d", with_views(f"SELECT usage_date, endpoint, call_count FROM usage WHERE usage_date >= {U_DAY} - 7",
                              "v_calls", extra=_usage_view()))
def q_usage_7d(spark, sf):
    return usage.usage_last_days(_usage(spark, sf), USAGE_DAY, 7)


@query("usage_30d_total", with_views(f"""
SELECT usage_date, CAST(sum(call_count) AS BIGINT) AS total_calls FROM usage WHERE usage_date >= {U_DAY} - 30 GROUP BY usage_date""",
                                     "v_calls", extra=_usage_view()))
def q_usage_30d_total(spark, sf):
    return usage.usage_daily_total(_usage(spark, sf), USAGE_DAY, 30)


@query("merge_counters", with_views("""
SELECT coalesce(t.usage_date, i.usage_date) AS usage_date, coalesce(t.endpoint, i.endpoint) AS endpoint,
       coalesce(t.call_count, 0) + coalesce(i.call_count, 0) AS call_count,
       coalesce(t.created_at, i.created_at) AS created_at, coalesce(i.updated_at, t.updated_at) AS updated_at
FROM t FULL OUTER JOIN i ON t.usage_date = i.usage_date AND t.endpoint = i.endpoint""", "v_calls", extra={
    "t": USAGE_SQL.format(where=f"{BILLABLE} AND event_id % 2 = 0"),
    "i": USAGE_SQL.format(where=f"{BILLABLE} AND event_id % 2 = 1")}))
def q_merge_counters(spark, sf):
    """Counter table of the even calls, merged with the odd calls as raw
    increments (one row per call, aggregated by the merge itself)."""
    calls = S.calls(spark, sf)
    target = usage.usage_daily(calls.filter(F.col("event_id") % 2 == 0))
    inc = (usage.billable_calls(calls.filter(F.col("event_id") % 2 == 1))
           .select(F.to_date("ts").alias("usage_date"), "endpoint", F.lit(1).cast("bigint").alias("call_count"),
                   F.col("ts").alias("created_at"), F.col("ts").alias("updated_at")))
    return usage.merge_counters(target, inc)


# --- planning ------------------------------------------------------------

PRIO = 500


def _selection(spark, sf):
    return sel.select_priority(S.status(spark, sf), AS_OF, PRIO)


@query("plan_sales_windows", _prio_sql(f"""
SELECT asin, start_date, end_date, start_date > end_date AS is_empty_window FROM (
  SELECT asin, CASE WHEN sales_estimate_data_synced_at IS NULL THEN {shift_date_sql("DATE '2024-02-01'", years=-1, days=-1)}
                    ELSE CAST(sales_estimate_data_synced_at AS DATE) END AS start_date,
         DATE '2024-01-31' AS end_date FROM selection) w"""))
def q_plan_sales_windows(spark, sf):
    return windows.plan_sales_windows(_selection(spark, sf), AS_OF)


@query("plan_fixed_window", with_views(f"""
SELECT asin, {shift_date_sql("DATE '2024-02-01'", months=-1, days=-1)} AS start_date,
       DATE '2024-01-31' AS end_date, '1month' AS date_range
FROM v_status WHERE has_product_data = true AND has_sales_data = false""", "v_status"))
def q_plan_fixed_window(spark, sf):
    return windows.plan_fixed_window(sel.needs_sales(S.status(spark, sf)), AS_OF, "1month")


@query("clamp_window", with_views(f"""
SELECT asin, CASE WHEN start_date < {shift_date_sql('end_date', years=-1)} THEN {shift_date_sql('end_date', years=-1)}
                  ELSE start_date END AS start_date,
       end_date, start_date AS original_start_date,
       start_date < {shift_date_sql('end_date', years=-1)} AS date_range_adjusted
FROM v_spans""", "v_spans"))
def q_clamp_window(spark, sf):
    return windows.clamp_window(S.spans(spark, sf))


ISO = "(regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_strptime({c}, '%Y-%m-%d') IS NOT NULL)"
MODE = "CASE WHEN coalesce(force_resync, false) THEN 'fresh' ELSE coalesce(sync_mode, 'fresh') END"


@query("validate_requests", with_views(f"""
SELECT *, {MODE} AS sync_mode_normalised,
  CASE WHEN coalesce(marketplace, '') = '' OR coalesce(start_date, '') = '' OR coalesce(end_date, '') = '' THEN 'missing_required'
       WHEN NOT {ISO.format(c='start_date')} THEN 'bad_start_date'
       WHEN NOT {ISO.format(c='end_date')} THEN 'bad_end_date'
       WHEN n_keys < 1 THEN 'no_keys' WHEN n_keys > 100 THEN 'too_many_keys'
       WHEN {MODE} NOT IN ('fresh', 'resume') THEN 'bad_sync_mode'
       WHEN coalesce(date_range, '') NOT IN ('1month', '1year') THEN 'bad_date_range' END AS reject_reason
FROM v_requests""", "v_requests"))
def q_validate_requests(spark, sf):
    return windows.validate_requests(S.requests(spark, sf))


@query("plan_batches", with_views("""
SELECT asin, row_number() OVER (ORDER BY asin) AS position,
       (row_number() OVER (ORDER BY asin) - 1) // 100 + 1 AS batch_no,
       CAST(ceil(count(*) OVER () / 100) AS BIGINT) AS batch_count
FROM (SELECT DISTINCT asin FROM v_catalog WHERE product_visibility AND asin IS NOT NULL AND asin <> '') v""",
                                  "v_catalog"))
def q_plan_batches(spark, sf):
    return batches.plan_batches(sel.visible_asins(S.catalog(spark, sf)))


@query("dedupe_last", with_views("""
SELECT asin, seq, kind, "at", error_text FROM (
  SELECT *, row_number() OVER (PARTITION BY asin ORDER BY seq DESC) AS rn FROM v_events) t WHERE rn = 1""",
                                 "v_events"))
def q_dedupe_last(spark, sf):
    return batches.dedupe_last(S.status_events(spark, sf), ["asin"], "seq")


@query("stop_point", with_views("""
SELECT r.run_id, s.stop_batch FROM (SELECT DISTINCT run_id FROM v_batches) r
LEFT JOIN (SELECT run_id, min(batch_no) AS stop_batch FROM stk WHERE streak >= 3 GROUP BY run_id) s ON r.run_id = s.run_id""",
                                "v_batches", extra={
    "p": "SELECT run_id, batch_no, returned > 0 AND stored = 0 AS f FROM v_batches WHERE NOT fetch_failed",
    "isl": "SELECT *, sum(CASE WHEN f THEN 0 ELSE 1 END) OVER (PARTITION BY run_id ORDER BY batch_no) AS island FROM p",
    "stk": "SELECT *, sum(CASE WHEN f THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, island ORDER BY batch_no) AS streak FROM isl"}))
def q_stop_point(spark, sf):
    return batches.stop_point(S.batches(spark, sf))
