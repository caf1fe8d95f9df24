"""Key, formatting and label queries (KEY-1..3, FMT-1..3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions import keys, text
from quayside.operators.grouped import grouped_report
from quayside.operators.unique_keys import unique_keys
from quayside.plans.q_flatten import _flat
from quayside.plans.registry import query
from quayside.sources import standin_docs as D
from quayside.sources import standins as S
from quayside.sources.standins import asin_of, with_views
from quayside.sources.tables import read_table

A = "concat('B', lpad(CAST(p_partkey AS VARCHAR), 9, '0'))"


@query("surrogate_key", f"SELECT {A} AS asin, concat('p', {keys.encoded_sql(A, 8)}) AS row_key FROM part")
def q_surrogate_key(spark, sf):
    p = read_table(spark, sf, "part")
    a = asin_of(F.col("p_partkey"))
    return p.select(a.alias("asin"), keys.surrogate_key(a, "p", 8).alias("row_key"))


@query("surrogate_key_32", f"SELECT {A} AS asin, {keys.encoded_sql(A, 32)} AS row_key FROM part")
def q_surrogate_key_32(spark, sf):
    p = read_table(spark, sf, "part")
    a = asin_of(F.col("p_partkey"))
    return p.select(a.alias("asin"), keys.surrogate_key_32(a).alias("row_key"))


@query("surrogate_key_unique", f"""
SELECT count(*) AS n_keys, count(*) AS n_values, count(DISTINCT {keys.encoded_sql(A, 3)}) AS n_first_draws FROM part""")
def q_surrogate_key_unique(spark, sf):
    """Three-character keys, which collide: every key gets a value of its own, and as many keep their first draw as
    there are different first draws. There are 62^3 such keys; where that is too few, the rest gets longer ones."""
    a = read_table(spark, sf, "part").select(asin_of(F.col("p_partkey")).alias("asin"))
    made = unique_keys(a, "asin", "row_key", lambda k: keys.encoded(k, 3), longer=lambda k, n: keys.encoded(k, 3 + n))
    return made.agg(F.count(F.lit(1)).alias("n_keys"), F.count_distinct("row_key").alias("n_values"),
                    F.count_if(F.col("row_key") == keys.encoded(F.col("asin"), 3)).alias("n_first_draws"))


AFF = "substr(concat('affiliate', CAST(l_suppkey AS VARCHAR)), 1, 10)"
ASN = "concat('B', lpad(CAST(l_partkey AS VARCHAR), 9, '0'))"
SRC = "CAST(l_linenumber AS VARCHAR)"
SEED = f"concat({AFF}, {ASN}, {SRC})"


@query("composite_key", f"""
SELECT l_orderkey, l_linenumber,
       substr(concat('ag', {AFF}, 'X', {ASN}, 'X', {SRC}, 'X', {keys.encoded_sql(SEED, 15)},
                     {keys.encoded_sql(f"concat({SEED}, '#pad')", 45)}), 1, 45) AS ad_group_id
FROM lineitem""")
def q_composite_key(spark, sf):
    li = read_table(spark, sf, "lineitem")
    aff = F.concat(F.lit("affiliate"), F.col("l_suppkey").cast("string"))
    return li.select("l_orderkey", "l_linenumber",
                     keys.composite_key(aff, asin_of(F.col("l_partkey")), F.col("l_linenumber")).alias("ad_group_id"))


K = "p_partkey"


@query("null_formatting", f"""
SELECT CASE WHEN {K} % 10 = 0 THEN '' ELSE {A} END AS asin,
  CASE WHEN {K} % 9 = 4 THEN '0' ELSE CAST(p_size * 7 AS VARCHAR) END AS reviews_text,
  CASE WHEN {K} % 6 = 0 THEN '0' ELSE CAST(p_size * 100 + {K} % 100 AS VARCHAR) END AS rank_text,
  CAST(CAST(CAST(CAST({K} % 5000 AS DECIMAL(8,3)) / 1000 AS DECIMAL(8,3)) AS DECIMAL(38,2)) AS VARCHAR) AS weight_text,
  CASE WHEN {K} % 10 = 7 THEN '0.00'
       ELSE CAST(CAST(CAST(CAST({K} % 900 AS DECIMAL(10,2)) / 100 + CAST({K} % 300 AS DECIMAL(10,2)) / 100
                           AS DECIMAL(10,2)) AS DECIMAL(38,2)) AS VARCHAR) END AS fee_text,
  CASE WHEN {K} % 3 = 0 THEN 'AMZ' WHEN {K} % 3 = 1 THEN 'FBA' ELSE '' END AS seller_text
FROM part WHERE NOT {D.BROKEN_SQL}""")
def q_null_formatting(spark, sf):
    p = _flat(spark, sf, "null", "script")
    return p.select("asin", text.int_text(F.col("reviews")).alias("reviews_text"),
                    text.int_text(F.col("product_rank")).alias("rank_text"),
                    text.money_text(F.col("weight_value")).alias("weight_text"),
                    text.money_text(F.col("fee_breakdown.total_fees")).alias("fee_text"),
                    text.str_text(F.col("seller_type")).alias("seller_text"))


def _sales_with_catalog(spark, sf):
    s = S.sales(spark, sf)
    c = S.catalog(spark, sf).select("asin", "title", "brand")
    return s.join(c, "asin").select(
        "asin", "title", "brand", "date", "estimated_units_sold",
        (F.col("estimated_units_sold") * F.col("last_known_price")).alias("revenue"))


MEASURES = {"units": "estimated_units_sold", "revenue": "revenue"}
SWC = """SELECT s.asin, c.title, c.brand, s.date, s.estimated_units_sold,
       s.estimated_units_sold * s.last_known_price AS revenue
FROM v_sales s JOIN v_catalog c ON s.asin = c.asin"""


def _grouped_sql(dims: str, group: str) -> str:
    return with_views(f"""SELECT {dims}, CAST(sum(estimated_units_sold) AS BIGINT) AS units, sum(revenue) AS revenue
FROM swc GROUP BY {group}""", "v_sales", "v_catalog", extra={"swc": SWC})


@query("grouped_report_asin", _grouped_sql(
    "asin AS group_value, title AS product_title, concat('img/', asin, '.jpg') AS product_image", "1, 2, 3"))
def q_grouped_report_asin(spark, sf):
    df = _sales_with_catalog(spark, sf).select(
        F.col("asin").alias("group_value"), F.col("title").alias("product_title"),
        F.concat(F.lit("img/"), F.col("asin"), F.lit(".jpg")).alias("product_image"), "estimated_units_sold", "revenue")
    return grouped_report(df, "asin", MEASURES)


@query("grouped_report_store", _grouped_sql("brand AS group_value, concat('store-', brand) AS store_id", "1, 2"))
def q_grouped_report_store(spark, sf):
    df = _sales_with_catalog(spark, sf).select(
        F.col("brand").alias("group_value"), F.concat(F.lit("store-"), F.col("brand")).alias("store_id"),
        "estimated_units_sold", "revenue")
    return grouped_report(df, "store_id", MEASURES)


@query("grouped_report_other", _grouped_sql("CAST(date AS VARCHAR) AS group_value", "1"))
def q_grouped_report_other(spark, sf):
    df = _sales_with_catalog(spark, sf).select(F.col("date").cast("string").alias("group_value"),
                                               "estimated_units_sold", "revenue")
    return grouped_report(df, "month", MEASURES)


ROLES = ["afm", "subadmin", "admin", "publisher", "advertiser", "viewer"]


@query("role_labels", f"""
SELECT c_custkey, role, CASE role {" ".join(f"WHEN '{r}' THEN '{lbl}'" for r, lbl in text.ROLE_LABELS.items())}
                       ELSE '{text.DEFAULT_LABEL}' END AS designation
FROM (SELECT c_custkey, CASE c_custkey % 7 {" ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(ROLES))} END AS role
      FROM customer) c""")
def q_role_labels(spark, sf):
    c = read_table(spark, sf, "customer")
    role = F.when(F.lit(False), None)
    for i, r in enumerate(ROLES):
        role = role.when(F.col("c_custkey") % 7 == i, r)
    return text.role_labels(c.select("c_custkey", role.alias("role")))
