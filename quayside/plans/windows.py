"""Request planning: date windows, clamping and argument checks (PLN-1..6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import date_lit, lenient_date, shift_date

# Fixed values of the reference's request rules.
MAX_KEYS_PER_REQUEST = 100
SYNC_MODES = ("fresh", "resume")
DATE_RANGES = {"1month": (0, -1, -1), "1year": (-1, 0, -1)}  # (years, months, days) from the run day


def yesterday(as_of: dt.datetime) -> Column:
    return F.date_sub(date_lit(as_of.date()), 1)


def plan_sales_windows(selection: DataFrame, as_of: dt.datetime,
                       synced_col: str = "sales_estimate_data_synced_at") -> DataFrame:
    """PLN-1 (+PLN-6): per key, never synced -> one year back from
    yesterday; else from the day of the last sync to yesterday. A key synced
    today gets start > end; ``is_empty_window`` flags it (no guard, as in
    the reference)."""
    run_day = date_lit(as_of.date())
    start = (F.when(F.col(synced_col).isNull(), shift_date(run_day, years=-1, days=-1))
             .otherwise(F.to_date(F.col(synced_col))))
    end = yesterday(as_of)
    return (selection.select("asin", start.alias("start_date"), end.alias("end_date"))
            .withColumn("is_empty_window", F.col("start_date") > F.col("end_date")))


def plan_fixed_window(keys: DataFrame, as_of: dt.datetime, date_range: str = "1month") -> DataFrame:
    """PLN-2: the full run's one window for every key."""
    if date_range not in DATE_RANGES:
        raise ValueError("date_range must be '1month' or '1year'")
    y, m, d = DATE_RANGES[date_range]
    run_day = date_lit(as_of.date())
    return keys.select("asin", shift_date(run_day, years=y, months=m, days=d).alias("start_date"),
                       yesterday(as_of).alias("end_date"), F.lit(date_range).alias("date_range"))


def clamp_window(requests: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """PLN-3: a window longer than one year starts one calendar year before
    its end; ``date_range_adjusted`` records the change."""
    floor = shift_date(F.col(end), years=-1)
    adjusted = F.col(start) < floor
    return requests.withColumns({
        "original_start_date": F.col(start),
        start: F.when(adjusted, floor).otherwise(F.col(start)),
        "date_range_adjusted": F.coalesce(adjusted, F.lit(False)),
    })


def normalise_sync_mode(mode: Column, force_resync: Column) -> Column:
    """PLN-5: missing mode -> fresh; legacy ``force_resync`` -> fresh."""
    return F.when(F.coalesce(force_resync, F.lit(False)), F.lit("fresh")).otherwise(F.coalesce(mode, F.lit("fresh")))


def validate_requests(requests: DataFrame) -> DataFrame:
    """PLN-4: first failing check per request as ``reject_reason`` (NULL
    when the request is valid). Checks, in the reference's order: required
    fields, ISO start, ISO end, key count 1..100, sync mode, date range."""
    def blank(c):
        return F.col(c).isNull() | (F.col(c) == "")
    mode = normalise_sync_mode(F.col("sync_mode"), F.col("force_resync"))
    reason = (F.when(blank("marketplace") | blank("start_date") | blank("end_date"), "missing_required")
              .when(lenient_date(F.col("start_date")).isNull(), "bad_start_date")
              .when(lenient_date(F.col("end_date")).isNull(), "bad_end_date")
              .when(F.col("n_keys") < 1, "no_keys")
              .when(F.col("n_keys") > MAX_KEYS_PER_REQUEST, "too_many_keys")
              .when(~mode.isin(*SYNC_MODES), "bad_sync_mode")
              .when(~F.coalesce(F.col("date_range"), F.lit("")).isin(*DATE_RANGES), "bad_date_range"))
    return requests.withColumns({"sync_mode_normalised": mode, "reject_reason": reason})


def check_request_args(n_keys: int, sync_mode: str = "fresh", date_range: str = "1month",
                       force_resync: bool = False) -> str:
    """Python-side form of PLN-4/5 for driver arguments; returns the mode."""
    if force_resync:
        sync_mode = "fresh"
    if not 1 <= n_keys <= MAX_KEYS_PER_REQUEST:
        raise ValueError(f"between 1 and {MAX_KEYS_PER_REQUEST} keys per request, got {n_keys}")
    if sync_mode not in SYNC_MODES:
        raise ValueError("sync_mode must be 'fresh' or 'resume'")
    if date_range not in DATE_RANGES:
        raise ValueError("date_range must be '1month' or '1year'")
    return sync_mode
