"""Grouped reports with a chosen dimension (FMT-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Group-by dimension -> columns of the report.
GROUP_COLUMNS = {
    "asin": ["group_value", "product_title", "product_image"],
    "store_id": ["group_value", "store_id"],
}
DEFAULT_GROUP_COLUMNS = ["group_value"]


def group_columns(group_by: str) -> list[str]:
    return GROUP_COLUMNS.get(group_by, DEFAULT_GROUP_COLUMNS)


def grouped_report(df: DataFrame, group_by: str, measures: dict[str, str]) -> DataFrame:
    """Sum ``measures`` (output name -> column) per the dimension's
    columns. ``df`` carries ``group_value`` and the dimension's columns.
    Decimal sums are widened to 38 digits (money totals need the room)."""
    cols = group_columns(group_by)
    aggs = []
    for n, c in measures.items():
        s = F.sum(c)
        if isinstance(df.schema[c].dataType, T.DecimalType):
            s = s.cast(T.DecimalType(38, df.schema[c].dataType.scale))
        aggs.append(s.alias(n))
    return df.groupBy(*cols).agg(*aggs)
