"""Ad-hoc syncs, the keyword load, its access paths, and the rules as SQL functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quayside.functions.keys import encoded_sql
from quayside.functions.sql import register_sql_functions
from quayside.operators import flatten as flt
from quayside.plans import adhoc, keyword_load
from quayside.plans.registry import query
from quayside.plans.runs import PRODUCT_TABLE, SALES, RunTargets
from quayside.session import ensure_checkpoint_dir
from quayside.sinks import keyword_paths, sales_layout
from quayside.sinks.defaults import with_defaults
from quayside.sinks.publish import Target, publish_one, read_live
from quayside.sources import payloads
from quayside.sources import standin_docs as D
from quayside.sources import standins as S
from quayside.sources.standins import AS_OF, asin_of, with_views
from quayside.sources.tables import read_table

# Keys that the targets hold before the request, by their last digit.
ON_STAGING, ON_PRODUCTION = ("0", "3", "6", "9"), ("0", "6")


def _root(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _held(digits):
    return F.substring("asin", -1, 1).isin(*digits)


def _held_sql(digits, asin="asin"):
    return f"right({asin}, 1) IN ({', '.join(repr(d) for d in digits)})"


def _counts_sql(ok):
    return ",\n".join(f"CAST(count(*) FILTER ({ok} AND {n}{_held_sql(d)}) AS BIGINT) AS {t}_{a}"
                      for t, d in (("staging", ON_STAGING), ("production", ON_PRODUCTION))
                      for a, n in (("inserted", "NOT "), ("updated", "")))


ZERO_SQL = "0, 0, 0, 0"


@query("adhoc_products", f"""
SELECT request_id, DATE '2024-02-01' AS report_date, CASE WHEN broken THEN 'parse_error' ELSE 'ok' END AS outcome,
       count(*) AS asins_requested, CAST(count(*) FILTER (NOT broken) AS BIGINT) AS products_found, {_counts_sql("NOT broken")}
FROM (SELECT p_partkey // 100 AS request_id, {D.BROKEN_SQL} AS broken, {D.code_asin_sql()} AS asin FROM part)
GROUP BY 1, broken
UNION ALL
SELECT -p_partkey - 1, DATE '2024-02-01', 'empty_response', 1, 0, {ZERO_SQL} FROM part WHERE p_partkey % 250 = 0
UNION ALL
SELECT 1000000000 + r_regionkey, DATE '2024-02-01', CASE WHEN r_regionkey = 0 THEN 'no_keys' ELSE 'no_response' END,
       least(r_regionkey, 1), 0, {ZERO_SQL} FROM region""")
def q_adhoc_products(spark, sf):
    """A request for every hundred products, requests answered without items, one without keys, some without a response."""
    root = _root(spark, "adhoc-products")
    targets = RunTargets(Target(root, "dev_"), Target(root, "prod_"))
    docs = D.product_documents(spark, sf)
    rows = flt.flatten_products(payloads.good_documents(payloads.read_product_payloads(docs)), AS_OF.date(), AS_OF)
    for t, digits in ((targets.staging, ON_STAGING), (targets.production, ON_PRODUCTION)):
        publish_one(rows.where(_held(digits)), t, PRODUCT_TABLE, "0", partition_by="report_date")
    k = F.col("p_partkey")
    part, region = read_table(spark, sf, "part").select(k), read_table(spark, sf, "region")
    requests = (part.groupBy((k / 100).cast("long").alias("request_id")).agg(F.collect_list(asin_of(k)).alias("asins"))
                .unionByName(part.where(k % D.EMPTY_EVERY == 0)
                             .select((-k - 1).cast("long").alias("request_id"), F.array(asin_of(k)).alias("asins")))
                .unionByName(region.select(
                    (F.col("r_regionkey") + 1_000_000_000).cast("long").alias("request_id"),
                    F.when(F.col("r_regionkey") > 0, F.array("r_name")).otherwise(F.array().cast("array<string>")).alias("asins"))))
    return adhoc.sync_products(requests, docs.withColumnRenamed("doc_id", "request_id"), targets, AS_OF, "1")


YEAR_EARLIER = "CAST(date_trunc('month', end_date - INTERVAL 12 MONTH) + INTERVAL (day(end_date) - 1) DAY AS DATE)"


@query("adhoc_sales", with_views(f"""
SELECT request_id, asin, 'us' AS marketplace, CASE WHEN start_date < {YEAR_EARLIER} THEN {YEAR_EARLIER} ELSE start_date END AS start_date,
       end_date, start_date < {YEAR_EARLIER} AS date_range_adjusted, start_date AS original_start_date,
       CASE WHEN bad THEN 'bad_point' ELSE 'ok' END AS outcome,
       CAST(CASE WHEN empty THEN 0 WHEN bad THEN n + 1 ELSE n END AS BIGINT) AS total_records,
       {", ".join(f"CAST(CASE WHEN NOT bad AND NOT empty AND {x}{_held_sql(d)} THEN n ELSE 0 END AS BIGINT) AS {t}_{a}"
                  for t, d in (("staging", ON_STAGING), ("production", ON_PRODUCTION))
                  for a, x in (("inserted", "NOT "), ("updated", "")))}
FROM (SELECT k AS request_id, s.*, n, k % 50 = 7 AS empty, k % 23 = 0 AND k % 50 <> 7 AS bad
      FROM v_spans s JOIN (SELECT k, concat('B', lpad(CAST(k AS VARCHAR), 9, '0')) AS asin, count(*) AS n
                           FROM pts GROUP BY ALL) USING (asin))""", "v_spans", extra={"pts": D.SALES_POINTS_SQL}))
def q_adhoc_sales(spark, sf):
    """A request per product over the days its items were returned; responses with a bad point are stored on no target."""
    root = _root(spark, "adhoc-sales")
    targets = RunTargets(Target(root, "dev_"), Target(root, "prod_"), sales_buckets=2)
    docs = D.sales_documents(spark, sf)
    good = payloads.good_documents(payloads.read_sales_payloads(docs))
    rows = sales_layout.with_part(with_defaults(
        flt.flatten_sales(good, marketplace="us", first_item_only=True).where("date IS NOT NULL"), SALES, AS_OF),
        targets.sales_buckets)
    for t, digits in ((targets.staging, ON_STAGING), (targets.production, ON_PRODUCTION)):
        publish_one(rows.where(_held(digits)), t, SALES, "0", partition_by=sales_layout.PART)
    text = [F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("start_date", "end_date")]
    requests = S.spans(spark, sf).select(F.substring("asin", 2, 9).cast("long").alias("request_id"), "asin",
                                         F.lit("us").alias("marketplace"), *text)
    return adhoc.sync_sales(requests, docs.withColumnRenamed("doc_id", "request_id"), targets, AS_OF, "1")


def _loaded(spark, sf):
    """The keyword table after two loads: every other document, then all of them with other names."""
    target = Target(_root(spark, "keywords"), "dev_")
    docs = D.keyword_documents(spark, sf)
    keyword_load.load_keywords(docs.where("doc_id % 2 = 0"), target, "1")
    renamed = docs.withColumn("doc", F.regexp_replace("doc", '"name":"', '"name":"*'))
    keyword_load.load_keywords(renamed, target, "2")
    return target


KEYWORD_SQL = f"""
SELECT * REPLACE (CASE WHEN (CAST(split_part(id, '/', 2) AS BIGINT) // 50) % 2 = 0 THEN name ELSE '*' || name END AS name)
FROM ({D.keyword_rows_sql()})"""


@query("load_keywords", KEYWORD_SQL)
def q_load_keywords(spark, sf):
    return read_live(spark, _loaded(spark, sf), keyword_load.KEYWORDS, keyword_load.TABLE)


ASIN, NAME, CATEGORY = "B000000077", "src1", "de"


@query("keyword_lookup", with_views(f"""
SELECT 'primary_asin' AS path, id, country, name, primary_asin, dominant_category FROM kw WHERE primary_asin = '{ASIN}'
UNION ALL SELECT 'name', id, country, name, primary_asin, dominant_category FROM kw WHERE name = '{NAME}' AND country = '{CATEGORY}'
UNION ALL SELECT 'dominant_category', id, country, name, primary_asin, dominant_category FROM kw
WHERE dominant_category = '{CATEGORY}'""", extra={"kw": KEYWORD_SQL}))
def q_keyword_lookup(spark, sf):
    """The loaded keywords by key, by name within a country, and by category."""
    root = _root(spark, "keyword-paths")
    keyword_load.write_access_paths(spark, _loaded(spark, sf), root)
    found = {"primary_asin": keyword_paths.lookup(spark, root, keyword_load.TABLE, primary_asin=ASIN),
             "name": keyword_paths.lookup(spark, root, keyword_load.TABLE, country=CATEGORY, name=NAME),
             "dominant_category": keyword_paths.lookup(spark, root, keyword_load.TABLE, dominant_category=CATEGORY)}
    parts = [rows.select(F.lit(path).alias("path"), "id", "country", "name", "primary_asin", "dominant_category")
             for path, rows in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("keyword_top", with_views("\nUNION ALL\n".join(
    f"(SELECT '{c}' AS path, id, {c}::VARCHAR AS value FROM kw ORDER BY {c} DESC NULLS LAST, id LIMIT 25)"
    for c in keyword_paths.ORDERS), extra={"kw": KEYWORD_SQL}))
def q_keyword_top(spark, sf):
    """The highest 25 keywords in each ordered column (a report), read from the highest zones."""
    root = _root(spark, "keyword-paths")
    keyword_load.write_access_paths(spark, _loaded(spark, sf), root)
    parts = [keyword_paths.top(spark, root, keyword_load.TABLE, c, 25)
             .select(F.lit(c).alias("path"), "id", F.col(c).cast("string").alias("value")) for c in keyword_paths.ORDERS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


ID_SQL = "CASE k % 4 WHEN 0 THEN concat('us/', a) WHEN 1 THEN concat('us/', a, '/v2') WHEN 2 THEN a ELSE '' END"


@query("sql_functions", f"""
SELECT k, CASE k % 4 WHEN 0 THEN a WHEN 1 THEN concat('us/', a, '/v2') WHEN 2 THEN a ELSE '' END AS asin,
       CASE k % 4 WHEN 2 THEN a WHEN 3 THEN '' ELSE 'us' END AS marketplace, CASE WHEN k % 4 < 2 THEN a ELSE '' END AS script_asin,
       CAST(date_trunc('month', CAST(d AS DATE) - INTERVAL 12 MONTH) + INTERVAL (day(CAST(d AS DATE)) - 2) DAY AS DATE) AS year_before,
       concat('p', {encoded_sql("a", 8)}) AS row_key, concat('x', {encoded_sql("a", 40)}) AS long_key
FROM (SELECT o_orderkey AS k, concat('B', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS a, o_orderdate AS d FROM orders)""")
def q_sql_functions(spark, sf):
    """The rules called from SQL text."""
    register_sql_functions(spark)
    return spark.sql(f"""
SELECT k, qs_asin_from_id(id) AS asin, qs_id_marketplace(id) AS marketplace, qs_id_asin(id) AS script_asin,
       qs_shift_date(CAST(d AS DATE), -1, 0, -1) AS year_before, qs_surrogate_key(a, 'p', 8) AS row_key,
       qs_surrogate_key(a, 'long', 40) AS long_key
FROM (SELECT *, {ID_SQL} AS id FROM (SELECT o_orderkey AS k, concat('B', lpad(CAST(o_custkey AS STRING), 9, '0')) AS a,
                                            o_orderdate AS d FROM {{orders}}))""",
                     orders=read_table(spark, sf, "orders"))
