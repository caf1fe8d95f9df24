"""Date and time expressions.

Calendar arithmetic follows the reference's rule: add years, months and
days to the fields, then normalise overflow *forward* (2024-02-29 minus one
year is 2023-03-01, not 2023-02-28 as ``add_months`` gives).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(t: dt.datetime) -> Column:
    """Zone-less timestamp literal (independent of the session time zone)."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def date_lit(d: dt.date) -> Column:
    return F.lit(d.strftime("%Y-%m-%d")).cast("date")


def shift_date(d: Column, years: int = 0, months: int = 0, days: int = 0) -> Column:
    """Calendar shift with forward overflow normalisation.

    First day of the target month, plus the original day-of-month minus one,
    plus ``days``: a day that does not exist in the target month rolls into
    the next one, exactly like field-wise addition followed by normalisation.
    """
    first = F.trunc(F.add_months(d, 12 * years + months), "MM")
    return F.date_add(first, F.dayofmonth(d) - 1 + days)


def shift_date_sql(d: str, years: int = 0, months: int = 0, days: int = 0) -> str:
    """DuckDB twin of :func:`shift_date` for oracles."""
    m = 12 * years + months
    return (f"CAST(date_trunc('month', CAST({d} AS DATE) + INTERVAL ({m}) MONTH) "
            f"+ INTERVAL (day(CAST({d} AS DATE)) - 1 + ({days})) DAY AS DATE)")


def lenient_date(s: Column) -> Column:
    """FLT-7: strict ``yyyy-MM-dd``; empty or unparsable text gives NULL."""
    return F.try_to_date(s, "yyyy-MM-dd")


RFC3339_PATTERNS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX",
)


def lenient_timestamp(s: Column) -> Column:
    """FLT-8: RFC 3339 (``Z`` or numeric offset, optional fraction) to a
    zone-less UTC timestamp; anything else gives NULL."""
    return F.try_to_timestamp(s, F.lit(RFC3339_PATTERNS[0])).cast("timestamp_ntz")
