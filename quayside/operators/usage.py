"""API usage counting (AGG-3..9) and the additive counter merge (UPS-5).

A call log ``(event_id, ts, endpoint, status, n_items)`` is counted per
(day, endpoint). ``groupBy`` aggregates partially on the map side, so a hot
endpoint costs one partial row per input partition, not one row per call.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import date_lit

COUNTER_KEYS = ["usage_date", "endpoint"]


def billable_calls(calls: DataFrame, policy: str = "code") -> DataFrame:
    """AGG-4 / AGG-5: which responses count.

    ``code`` (default, what the reference does): status 200 with at least
    one item. ``documented`` (what its README states): every response that
    has a status, errors included; network failures (no status) never count.
    """
    if policy == "code":
        return calls.filter((F.col("status") == 200) & (F.col("n_items") > 0))
    if policy == "documented":
        return calls.filter(F.col("status").isNotNull())
    raise ValueError(f"unknown usage policy {policy!r}")


def usage_daily(calls: DataFrame, policy: str = "code") -> DataFrame:
    """AGG-3: counter rows ``(usage_date, endpoint, call_count, created_at,
    updated_at)``; the stamps are the first and last counted call."""
    return (billable_calls(calls, policy)
            .groupBy(F.to_date("ts").alias("usage_date"), "endpoint")
            .agg(F.count(F.lit(1)).alias("call_count"),
                 F.min("ts").alias("created_at"), F.max("ts").alias("updated_at")))


def merge_counters(target: DataFrame, increments: DataFrame, keys: list[str] = COUNTER_KEYS) -> DataFrame:
    """UPS-5: ``call_count`` adds up; an existing row keeps its
    ``created_at``; ``updated_at`` comes from the latest increment.

    Union + one ``groupBy``: increments need not be pre-aggregated (partial
    aggregation does that before the shuffle), and the target is read once.
    """
    t = target.select(*keys, "call_count", "created_at", "updated_at", F.lit(0).alias("_src"))
    i = increments.select(*keys, "call_count", "created_at", "updated_at", F.lit(1).alias("_src"))
    return (t.unionByName(i).groupBy(*keys).agg(
        F.sum("call_count").alias("call_count"),
        F.coalesce(F.min(F.when(F.col("_src") == 0, F.col("created_at"))), F.min("created_at")).alias("created_at"),
        F.coalesce(F.max(F.when(F.col("_src") == 1, F.col("updated_at"))), F.max("updated_at")).alias("updated_at")))


def usage_today(usage: DataFrame, day: dt.date) -> DataFrame:
    """AGG-6: one day's counts, by endpoint (a few rows, so sorting is free)."""
    return (usage.filter(F.col("usage_date") == date_lit(day)).select("endpoint", "call_count", "updated_at")
            .orderBy("endpoint"))


def usage_yesterday(usage: DataFrame, day: dt.date) -> DataFrame:
    """AGG-7: the previous day's totals per endpoint."""
    return usage.filter(F.col("usage_date") == F.date_sub(date_lit(day), 1)).select("endpoint", "call_count")


def usage_last_days(usage: DataFrame, day: dt.date, days: int = 7) -> DataFrame:
    """AGG-8: the last ``days`` days per endpoint, newest first."""
    return (usage.filter(F.col("usage_date") >= F.date_sub(date_lit(day), days))
            .select("usage_date", "endpoint", "call_count").orderBy(F.desc("usage_date"), "endpoint"))


def usage_daily_total(usage: DataFrame, day: dt.date, days: int = 30) -> DataFrame:
    """AGG-9: total over endpoints per day for the last ``days`` days."""
    return (usage.filter(F.col("usage_date") >= F.date_sub(date_lit(day), days))
            .groupBy("usage_date").agg(F.sum("call_count").alias("total_calls")).orderBy(F.desc("usage_date")))
