"""Text rendering of nullable values (FMT-1) and labels (FMT-3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def int_text(c: Column) -> Column:
    """Integer -> text; NULL -> ``'0'``."""
    return F.coalesce(c.cast("bigint").cast("string"), F.lit("0"))


def money_text(c: Column) -> Column:
    """Number -> text with two decimals; NULL -> ``'0.00'``. Works on the
    decimal value (half up), never on a binary double."""
    return F.coalesce(c.cast("decimal(38,2)").cast("string"), F.lit("0.00"))


def str_text(c: Column) -> Column:
    """String -> itself; NULL -> ``''``."""
    return F.coalesce(c, F.lit(""))


# Role -> designation, and the fallback.
ROLE_LABELS = {
    "afm": "Affiliate Manager",
    "subadmin": "Sub Admin",
    "admin": "Admin",
    "publisher": "Affiliate",
    "advertiser": "Advertiser",
}
DEFAULT_LABEL = "User"


def role_labels(df: DataFrame, role_col: str = "role", out: str = "designation") -> DataFrame:
    """FMT-3: label per role with fallback. The lookup has five rows, so its
    broadcast is bounded by construction."""
    spark: SparkSession = df.sparkSession
    lookup = spark.createDataFrame(list(ROLE_LABELS.items()), f"_role string, {out} string")
    j = df.join(F.broadcast(lookup), df[role_col] == lookup["_role"], "left").drop("_role")
    return j.withColumn(out, F.coalesce(F.col(out), F.lit(DEFAULT_LABEL)))
