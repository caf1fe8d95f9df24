"""Sales time-series summaries (AGG-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sales_summary(sales: DataFrame, asin: str | None = None) -> DataFrame:
    """AGG-1: per key: days, first and last day, units, revenue rounded to
    cents. Decimal arithmetic throughout. ``asin`` keeps one key (SEL-9); the
    filter is pushed into the scan."""
    if asin is not None:
        sales = sales.filter(F.col("asin") == asin)
    units = F.col("estimated_units_sold")
    return sales.groupBy("asin").agg(
        F.count(F.lit(1)).alias("days_count"), F.min("date").alias("start_date"),
        F.max("date").alias("end_date"), F.sum(units).alias("total_units"),
        F.round(F.sum(units * F.col("last_known_price")), 2).cast("decimal(38,2)").alias("total_revenue"))
