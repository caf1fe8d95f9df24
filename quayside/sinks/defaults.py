"""Column defaults of the stored tables (SNK-5), applied by the writer.

Without a table format a default cannot live in the table, so it is declared
here and added before a write: a column that the rows do not carry gets its
default, as an ``INSERT`` that leaves the column out would. A NULL that the
rows do carry stays NULL; whether the table can hold it is for the row
validation (SNK-4) to say.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.dates import ts_lit
from quayside.schemas import SALES_TABLE, STATUS_TABLE, USAGE_TABLE

NOW = "now"
# The reference's column defaults.
DEFAULTS: dict[str, dict[str, object]] = {
    "sales_estimate_data": {"marketplace": "us", "is_parent": False, "is_variant": False, "is_standalone": False,
                            "created_at": NOW, "updated_at": NOW},
    "sync_status": {"has_product_data": False, "has_sales_data": False, "created_at": NOW, "updated_at": NOW},
    "api_usage": {"call_count": 0, "created_at": NOW, "updated_at": NOW},
}
SCHEMAS: dict[str, T.StructType] = {"sales_estimate_data": SALES_TABLE, "sync_status": STATUS_TABLE,
                                    "api_usage": USAGE_TABLE}


def with_defaults(rows: DataFrame, table: str, as_of: dt.datetime) -> DataFrame:
    """``rows`` with the table's columns in their order; absent ones have their default, or NULL without one. Columns
    that the table does not have raise, as they would in an ``INSERT``."""
    schema, defaults = SCHEMAS[table], DEFAULTS[table]
    if unknown := [c for c in rows.columns if c not in schema.fieldNames()]:
        raise ValueError(f"{table} has no column {', '.join(unknown)}")
    out = []
    for field in schema.fields:
        if field.name in rows.columns:
            value = F.col(field.name)
        else:
            default = defaults.get(field.name)
            value = ts_lit(as_of) if default == NOW else F.lit(default)
        out.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*out)
