"""Upsert queries over the stand-in sales and keyword tables (UPS-3/4, AGG-10)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from quayside.functions.dates import ts_lit
from quayside.operators import upsert as ups
from quayside.plans.registry import query
from quayside.session import ensure_checkpoint_dir
from quayside.sinks.publish import Target, publish_one
from quayside.sources import standins as S
from quayside.sources.standins import AS_OF, with_views

NOW = "TIMESTAMP '2024-02-01 00:00:00'"
SALES_TARGET_SQL = """SELECT *, estimated_units_sold % 97 AS rank, TIMESTAMP '2023-12-01 00:00:00' AS created_at,
       TIMESTAMP '2023-12-15 00:00:00' AS updated_at FROM v_sales"""


def sales_target(spark, sf):
    """Stored sales with the columns the source does not carry."""
    return S.sales(spark, sf).withColumns({
        "rank": F.col("estimated_units_sold") % 97,
        "created_at": ts_lit(dt.datetime(2023, 12, 1)), "updated_at": ts_lit(dt.datetime(2023, 12, 15))})


def merged_sales(spark, sf):
    return ups.upsert_sales(sales_target(spark, sf), S.sales_new(spark, sf), AS_OF, partition_by=["date"],
                            on_duplicate="unique")


UPSERT_SALES_SQL = f"""
SELECT coalesce(t.asin, s.asin) AS asin, coalesce(t.marketplace, s.marketplace) AS marketplace,
       CASE WHEN s.asin IS NOT NULL THEN s.is_parent ELSE t.is_parent END AS is_parent,
       coalesce(t.date, s.date) AS date,
       CASE WHEN s.asin IS NOT NULL THEN s.estimated_units_sold ELSE t.estimated_units_sold END AS estimated_units_sold,
       CASE WHEN s.asin IS NOT NULL THEN s.last_known_price ELSE t.last_known_price END AS last_known_price,
       CASE WHEN t.asin IS NOT NULL THEN t.rank END AS rank,
       CASE WHEN t.asin IS NOT NULL THEN t.created_at ELSE {NOW} END AS created_at,
       CASE WHEN s.asin IS NOT NULL THEN {NOW} ELSE t.updated_at END AS updated_at,
       CASE WHEN t.asin IS NOT NULL AND s.asin IS NOT NULL THEN 'updated'
            WHEN s.asin IS NOT NULL THEN 'inserted' ELSE 'unchanged' END AS action
FROM tgt t FULL OUTER JOIN v_sales_new s ON t.asin = s.asin AND t.marketplace = s.marketplace AND t.date = s.date"""


@query("upsert_sales", with_views(UPSERT_SALES_SQL, "v_sales", "v_sales_new", extra={"tgt": SALES_TARGET_SQL}))
def q_upsert_sales(spark, sf):
    return merged_sales(spark, sf)


@query("upsert_counts", with_views(
    "SELECT CAST(count_if(action = 'inserted') AS BIGINT) AS inserted, CAST(count_if(action = 'updated') AS BIGINT) AS updated FROM m",
    "v_sales", "v_sales_new", extra={"tgt": SALES_TARGET_SQL, "m": UPSERT_SALES_SQL}))
def q_upsert_counts(spark, sf):
    return ups.upsert_counts(merged_sales(spark, sf))


@query("publish_counts", with_views(
    "SELECT CAST(count_if(action = 'inserted') AS BIGINT) AS inserted, CAST(count_if(action = 'updated') AS BIGINT) AS updated FROM m",
    "v_sales", "v_sales_new", extra={"tgt": SALES_TARGET_SQL, "m": UPSERT_SALES_SQL}))
def q_publish_counts(spark, sf):
    """The same counts, observed while the merged table is published."""
    staging = Target(f"{ensure_checkpoint_dir(spark).rstrip('/')}/counts-{uuid.uuid4().hex[:12]}", "dev_")
    rows, seen = ups.observed_counts(merged_sales(spark, sf))
    publish_one(rows, staging, "sales", "v1", partition_by="date")
    return spark.createDataFrame([(seen.get["inserted"], seen.get["updated"])], "inserted long, updated long")


KW = ["id", "country", "name", "monthly_search_volume_exact", "ease_of_ranking_score", "doc_id"]


@query("insert_ignore_keywords", with_views("""
SELECT *, 'unchanged' AS action FROM v_keywords WHERE doc_id % 2 = 0
UNION ALL
SELECT id, country, concat(name, '*') AS name, monthly_search_volume_exact, ease_of_ranking_score, doc_id,
       'inserted' AS action
FROM v_keywords WHERE doc_id % 2 <> 0""", "v_keywords"))
def q_insert_ignore_keywords(spark, sf):
    """Stored = even documents; fresh = all documents, renamed so a wrongly
    overwritten row would show."""
    kw = S.keywords(spark, sf)
    target = kw.filter(F.col("doc_id") % 2 == 0)
    source = kw.withColumn("name", F.concat("name", F.lit("*")))
    return ups.insert_ignore(target, source, ["id"], on_duplicate="unique")


@query("upsert_sales_last_wins", with_views(UPSERT_SALES_SQL, "v_sales", "v_sales_new", extra={"tgt": SALES_TARGET_SQL}))
def q_upsert_sales_last_wins(spark, sf):
    """Every key three times in one batch: two larger values first, the
    fresh row last. The last row of the sequence wins, not the greatest."""
    ensure_checkpoint_dir(spark)
    fresh = ups.dealt_by_key(S.sales_new(spark, sf).checkpoint(eager=True), ups.SALES_KEYS)
    batch = (fresh.withColumn("seq", F.explode(F.array(*[F.lit(seq) for seq in (1, 2, 3)])))
             .withColumn("estimated_units_sold", (F.col("estimated_units_sold") + (3 - F.col("seq")) * 1000).cast("int")))
    return ups.upsert_sales(sales_target(spark, sf), batch, AS_OF, partition_by=["date"], seq="seq")


@query("insert_ignore_first_wins", with_views("""
SELECT *, 'unchanged' AS action FROM v_keywords WHERE doc_id % 2 = 0
UNION ALL
SELECT id, country, concat(name, 'b') AS name, monthly_search_volume_exact, ease_of_ranking_score, doc_id,
       'inserted' AS action
FROM v_keywords WHERE doc_id % 2 <> 0""", "v_keywords"))
def q_insert_ignore_first_wins(spark, sf):
    """Stored = even documents; the source has every key twice, and the row
    that comes first has the smaller text, so a greatest-row rule would show."""
    kw = S.keywords(spark, sf)
    target = kw.filter(F.col("doc_id") % 2 == 0)
    first = kw.withColumns({"name": F.concat("name", F.lit("b")), "seq": F.lit(1)})
    second = kw.withColumns({"name": F.concat("name", F.lit("z")), "seq": F.lit(2)})
    return ups.insert_ignore(target, second.unionByName(first), ["id"], seq="seq")
