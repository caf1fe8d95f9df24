"""Access paths of the keyword table (SEL-9, SEL-10).

The reference declares seven indexes. Files have no indexes, but a scan can
skip what it need not read, so the table is written in layouts:

* ``by_country``: one folder a country, files ranged and sorted by
  ``primary_asin``, with Parquet Bloom filters on ``primary_asin``, ``name``
  and ``dominant_category``. A country prunes folders; an equality test skips
  row groups by their least and greatest value or by the filter.
* ``by_<column>``: one folder a zone of an ordered column, highest zone first:
  powers of two for a metric, months for ``updated_at``. The rows per zone are
  kept beside it. The top k rows lie in the highest zones that hold k rows
  together, and only those are read.

Cases: a NULL metric is in the zone below all others, also below negative
values, which share one; it comes last in an order. Ties go to the smaller id.
An empty text as country reads back as NULL, as
folders have it. An empty table has empty layouts. No column may be called ``zone``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOOKUPS = ("primary_asin", "name", "dominant_category")
ORDERS = ("monthly_search_volume_exact", "ease_of_ranking_score", "updated_at")
FILTER_VALUES = 1_000_000   # distinct values a row group's Bloom filter is made for
NONE, NEGATIVE = -2, -1     # zones


def zone_of(column: str, kind: str) -> Column:
    """The zone of a value: higher values are never in a lower zone."""
    c = F.col(column)
    if kind.startswith("timestamp") or kind == "date":
        return F.coalesce((F.year(c) * 12 + F.month(c)).cast("int"), F.lit(NONE))
    size = F.length(F.bin(F.floor(c).cast("long")))  # binary digits: 1 has one, 2 and 3 have two, and so on
    return (F.when(c.isNull(), NONE).when(c < 0, NEGATIVE).when(c < 1, 0).when(c >= F.lit(float(2 ** 62)), 64)
            .otherwise(size).cast("int"))


def write_paths(keywords: DataFrame, root: str, filter_values: int = FILTER_VALUES) -> None:
    """Write all layouts of ``keywords`` under ``root``, which must not have them yet."""
    writer = (keywords.repartitionByRange("country", "primary_asin").sortWithinPartitions("country", "primary_asin")
              .write.mode("error").partitionBy("country"))
    for c in LOOKUPS:
        writer = (writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{c}", str(filter_values)))
    writer.parquet(f"{root}/by_country")
    kinds = dict(keywords.dtypes)
    for c in ORDERS:
        zoned = keywords.withColumn("zone", zone_of(c, kinds[c]))
        zoned.hint("rebalance", "zone").write.mode("error").partitionBy("zone").parquet(f"{root}/by_{c}")
        zoned.groupBy("zone").agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.mode("error").parquet(f"{root}/zones_{c}")


def lookup(spark: SparkSession, root: str, schema, country: str | None = None, **equal: str) -> DataFrame:
    """Rows with the given ``primary_asin``, ``name`` or ``dominant_category``, of one country or of all."""
    if unknown := set(equal) - set(LOOKUPS):
        raise ValueError(f"no path for {', '.join(sorted(unknown))}")
    rows = spark.read.schema(schema).parquet(f"{root}/by_country")
    if country is not None:
        rows = rows.where(F.col("country") == country)
    for c, value in equal.items():
        rows = rows.where(F.col(c) == value)
    return rows.select(*schema.fieldNames())


def least_zone(spark: SparkSession, root: str, by: str, k: int) -> int | None:
    """The zone at which the rows from the top on reach ``k`` (the lowest one if they never do)."""
    zones = spark.read.schema("zone int, n long").parquet(f"{root}/zones_{by}")
    above = F.sum("n").over(Window.orderBy(F.col("zone").desc()))  # one row per zone: powers of two, or months
    return (zones.select("zone", above.alias("n")).agg(F.coalesce(F.max(F.when(F.col("n") >= k, F.col("zone"))),
                                                                  F.min("zone")).alias("z")).first().z)


def top(spark: SparkSession, root: str, schema, by: str, k: int, columns: Iterable[str] | None = None) -> DataFrame:
    """The ``k`` rows highest in ``by``, NULL last, ties to the smaller id."""
    if by not in ORDERS:
        raise ValueError(f"no path for {by}")
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("zone", T.IntegerType())])).parquet(f"{root}/by_{by}")
    zone = least_zone(spark, root, by, k)
    if zone is not None:
        rows = rows.where(F.col("zone") >= zone)
    return (rows.orderBy(F.col(by).desc_nulls_last(), F.col("id").asc()).limit(k)
            .select(*(columns or schema.fieldNames())))
