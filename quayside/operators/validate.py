"""Row-level validation before a write (SNK-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RejectedRowsError(ValueError):
    pass


def reject_reason(df: DataFrame, required: list[str]):
    """First required column that is NULL, as ``'<col> is null'``."""
    reason = None
    for c in required:
        cond = F.col(c).isNull()
        msg = F.lit(f"{c} is null")
        reason = F.when(cond, msg) if reason is None else reason.when(cond, msg)
    return reason


def mark_valid_rows(df: DataFrame, required: list[str]) -> DataFrame:
    """All rows with a ``reject_reason`` column (NULL = row can be written)."""
    return df.withColumn("reject_reason", reject_reason(df, required))


def split_valid_rows(df: DataFrame, required: list[str], strict: bool = False):
    """Return ``(good, rejected)``. The incremental run records a bad row
    and goes on; ``strict=True`` (the full run) raises on the first one."""
    marked = mark_valid_rows(df, required)
    rejected = marked.filter(F.col("reject_reason").isNotNull())
    if strict:
        bad = rejected.limit(1).collect()
        if bad:
            raise RejectedRowsError(f"row rejected: {bad[0].reject_reason}")
    return marked.filter(F.col("reject_reason").isNull()).drop("reject_reason"), rejected
