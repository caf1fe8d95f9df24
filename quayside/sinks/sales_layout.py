"""Folders of the sales table: one per key bucket and month.

A run brings some keys and some months. With folders by day, one new key
rewrites a year of every key's rows; with folders by bucket and month it
rewrites that key's bucket alone, and only the months it has points for. The
folder's name is ``<buckets>.<bucket>.<month>``, for example
``004.003.2024-01``, so a table says itself how it was dealt.

The folders a merge touches are found by a join: the run's points give their
folders (one row per folder at most), and dynamic partition pruning keeps the
scan of the table to them. No value passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.schemas import SALES_TABLE
from quayside.sinks.publish import Target, live_pointer, read_live

PART = "part"
# For small tables. Choose it so that a bucket's month is a file of good size (a million keys a bucket, say) and a run's
# keys fall into few of the buckets; another number deals the table anew at its next write.
BUCKETS = 4
SCHEMA = T.StructType(SALES_TABLE.fields + [T.StructField(PART, T.StringType())])


def part_of(asin: Column, date: Column, buckets: int = BUCKETS) -> Column:
    """The folder of a row."""
    bucket = F.pmod(F.xxhash64(asin), F.lit(buckets)).cast("string")
    return F.concat(F.lit(f"{buckets:03d}."), F.lpad(bucket, 3, "0"), F.lit("."), F.date_format(date, "yyyy-MM"))


def with_part(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    return rows.withColumn(PART, part_of(F.col("asin"), F.col("date"), buckets))


def is_dealt(spark: SparkSession, target: Target, name: str, buckets: int = BUCKETS) -> bool:
    """Whether every live folder of the table was dealt by this rule (at most one row per folder is looked at)."""
    live = live_pointer(spark, target, name)
    if live is None:
        return False
    other = live.where(~F.coalesce(F.col("part_value").startswith(f"{buckets:03d}."), F.lit(False)))
    return other.isEmpty()


def touched(table: DataFrame, points: DataFrame) -> DataFrame:
    """The rows of the folders that ``points`` fall into. Both carry ``part``.

    The folders are broadcast: as many as the table has at most. The comparison
    with the empty text holds for every folder; it tells the planner that the
    list is worth pruning by."""
    folders = points.select(PART).distinct().where(F.col(PART) > "")
    return table.join(F.broadcast(folders), PART, "left_semi")


def merge_input(spark: SparkSession, targets: list[Target], name: str, points: DataFrame,
                buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame, bool]:
    """(stored rows to merge with, points with their folder, whether only touched folders are written).

    The rows are the first target's; all of ``targets`` are written. If one of
    them is dealt otherwise (by day, or into another number of buckets), the
    table is merged and written whole once; from then on only its touched
    folders are."""
    points = with_part(points, buckets)
    if all(is_dealt(spark, t, name, buckets) for t in targets):
        return touched(read_live(spark, targets[0], name, SCHEMA), points), points, True
    return with_part(read_live(spark, targets[0], name, SALES_TABLE), buckets), points, False
