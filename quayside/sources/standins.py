"""Domain tables derived from the driver tables.

The engine works on a product catalog, a sync-status control table, daily
sales, an API call log, run outcomes, a batch log, status events and keyword
metrics. The test data is a TPC-H-like star schema, so each domain table is
derived from one or two driver tables by a fixed rule. Each rule exists twice:
as a DataFrame plan (what the queries run) and as SQL text (what the DuckDB
oracle runs). Both must give the same rows.

``AS_OF`` is the fixed run time all queries use; no query reads the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.sources.tables import read_table

AS_OF = dt.datetime(2024, 2, 1)
AS_OF_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


def asin_of(key: Column) -> Column:
    """Key number -> 10-char product key, ``B`` + 9 zero-padded digits."""
    return F.concat(F.lit("B"), F.lpad(key.cast("string"), 9, "0"))


def _days_before(day: str, n: Column) -> Column:
    return F.date_sub(F.lit(day).cast("date"), n).cast("timestamp_ntz")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    asin = (F.when(k % 101 == 100, F.lit(None).cast("string"))
            .when(k % 97 == 96, F.lit(""))
            .otherwise(asin_of(k)))
    return p.select(asin.alias("asin"), (k % 5 != 0).alias("product_visibility"),
                    F.col("p_name").alias("title"), F.col("p_brand").alias("brand"),
                    F.col("p_retailprice").cast("decimal(12,2)").alias("price"))


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    null_ts = F.lit(None).cast("timestamp_ntz")
    return p.filter(k % 3 != 0).select(
        asin_of(k).alias("asin"),
        F.when(k % 11 == 0, F.lit(None).cast("boolean")).otherwise(size > 20).alias("has_product_data"),
        F.when(k % 13 == 0, F.lit(None).cast("boolean")).otherwise(size > 30).alias("has_sales_data"),
        F.when(k % 7 == 0, F.lit("sales fetch error")).alias("error"),
        F.when(size > 20, _days_before("2024-02-01", size)).otherwise(null_ts).alias("product_data_synced_at"),
        F.when(size > 30, _days_before("2024-02-01", size * 10)).otherwise(null_ts)
        .alias("sales_estimate_data_synced_at"),
        F.when(k % 2 == 0, _days_before("2024-02-01", size)).otherwise(null_ts).alias("product_fetch_attempted_at"),
        F.when(k % 17 == 0, null_ts).otherwise(_days_before("2024-01-01", size)).alias("created_at"),
    )


SALES_ROWS_PER_TASK = 500_000


def _sales(spark: SparkSession, sf_dir: str, returned: bool) -> DataFrame:
    """Sales rows by key and month, dealt by their key into as many tasks as the rows need.

    Nearly every line is a group of its own, so grouping before the shuffle saves little and holds a whole input
    split; and tasks cut by compressed bytes hold far more of these short rows than their size tells."""
    li = read_table(spark, sf_dir, "lineitem")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-li.count() // SALES_ROWS_PER_TASK))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    flag = F.col("l_returnflag") == "R" if returned else F.col("l_returnflag") != "R"
    j = li.filter(flag).join(p, li.l_partkey == p.p_partkey)
    parent = (F.col("l_partkey") % 4 == (1 if returned else 0))
    bump = 1 if returned else 0
    dealt = j.select(asin_of(F.col("l_partkey")).alias("asin"), parent.alias("is_parent"),
                     F.date_trunc("month", F.col("l_shipdate")).cast("date").alias("date"),
                     "l_quantity", "p_retailprice").repartition(tasks, "asin", "date")
    rows = dealt.groupBy("asin", "is_parent", "date").agg(
        F.sum("l_quantity").cast("int").alias("estimated_units_sold"),
        (F.max("p_retailprice") + F.lit(bump)).cast("decimal(10,2)").alias("last_known_price"))
    return rows.select("asin", F.lit("us").alias("marketplace"), "is_parent", "date", "estimated_units_sold",
                       "last_known_price")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored daily sales (target of the sales upsert)."""
    return _sales(spark, sf_dir, returned=False)


def sales_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshly fetched daily sales (source of the sales upsert)."""
    return _sales(spark, sf_dir, returned=True)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls_from_events(read_table(spark, sf_dir, "events"))


def calls_from_events(e: DataFrame) -> DataFrame:
    """The call log of an event table (batch or stream)."""
    et = F.col("event_type")
    return e.select(
        "event_id", "ts",
        F.when(et.isin("view", "click"), "product_database_query").otherwise("sales_estimates_query").alias("endpoint"),
        F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("int")).when(et == "error", 500)
        .when(et == "signup", 429).otherwise(200).alias("status"),
        (F.get_json_object("props", "$.k").cast("int") % 10).alias("n_items"))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"),
        (et != "error").alias("stored"), et.isin("view", "click").alias("sales_ok"),
        F.when(et == "error", "db").when(et == "signup", "api").alias("error_kind"),
        F.when(et.isin("error", "signup"), F.concat(F.lit("failure "), F.col("event_id").cast("string")))
        .alias("message"))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("run_id"), F.row_number().over(w).cast("bigint").alias("batch_no"),
        (F.col("o_orderpriority") == "5-LOW").alias("fetch_failed"),
        F.lit(100).alias("returned"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(90).alias("stored"))


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    kind = F.when(et == "view", "product_stored").when(et == "click", "sales_stored") \
        .when(et == "error", "product_store_failed").when(et == "signup", "product_not_found") \
        .otherwise("sales_fetch_failed")
    return e.select(asin_of(F.col("user_id")).alias("asin"), F.col("event_id").alias("seq"),
                    kind.alias("kind"), F.col("ts").alias("at"),
                    F.concat(F.lit("failure "), F.col("event_id").cast("string")).alias("error_text"))


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.col("lang"), F.lit("/"), F.col("doc_id").cast("string")).alias("id"),
        F.col("lang").alias("country"), F.col("source").alias("name"),
        F.col("n_chars").cast("decimal(38,10)").alias("monthly_search_volume_exact"),
        (F.col("doc_id") % 100).cast("decimal(38,10)").alias("ease_of_ranking_score"),
        F.col("doc_id"))


# --- SQL twins for the DuckDB oracle (same rules, same rows) -------------

SQL_VIEWS: dict[str, str] = {
    "v_catalog": """
SELECT CASE WHEN p_partkey % 101 = 100 THEN NULL WHEN p_partkey % 97 = 96 THEN ''
            ELSE concat('B', lpad(CAST(p_partkey AS VARCHAR), 9, '0')) END AS asin,
       p_partkey % 5 <> 0 AS product_visibility, p_name AS title, p_brand AS brand,
       CAST(p_retailprice AS DECIMAL(12,2)) AS price
FROM part""",
    "v_status": """
SELECT concat('B', lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS asin,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size > 20 END AS has_product_data,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size > 30 END AS has_sales_data,
       CASE WHEN p_partkey % 7 = 0 THEN 'sales fetch error' END AS error,
       CASE WHEN p_size > 20 THEN CAST(DATE '2024-02-01' - p_size AS TIMESTAMP) END AS product_data_synced_at,
       CASE WHEN p_size > 30 THEN CAST(DATE '2024-02-01' - p_size * 10 AS TIMESTAMP) END AS sales_estimate_data_synced_at,
       CASE WHEN p_partkey % 2 = 0 THEN CAST(DATE '2024-02-01' - p_size AS TIMESTAMP) END AS product_fetch_attempted_at,
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(DATE '2024-01-01' - p_size AS TIMESTAMP) END AS created_at
FROM part WHERE p_partkey % 3 <> 0""",
    "v_sales": """
SELECT concat('B', lpad(CAST(l_partkey AS VARCHAR), 9, '0')) AS asin, 'us' AS marketplace, l_partkey % 4 = 0 AS is_parent,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS date, CAST(SUM(l_quantity) AS INT) AS estimated_units_sold,
       CAST(MAX(p_retailprice) AS DECIMAL(10,2)) AS last_known_price
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R' GROUP BY 1, 2, 3, 4""",
    "v_sales_new": """
SELECT concat('B', lpad(CAST(l_partkey AS VARCHAR), 9, '0')) AS asin, 'us' AS marketplace, l_partkey % 4 = 1 AS is_parent,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS date, CAST(SUM(l_quantity) AS INT) AS estimated_units_sold,
       CAST(MAX(p_retailprice) + 1 AS DECIMAL(10,2)) AS last_known_price
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R' GROUP BY 1, 2, 3, 4""",
    "v_calls": """
SELECT event_id, ts, CASE WHEN event_type IN ('view', 'click') THEN 'product_database_query' ELSE 'sales_estimates_query' END AS endpoint,
       CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_type = 'error' THEN 500 WHEN event_type = 'signup' THEN 429 ELSE 200 END AS status,
       CAST(json_extract_string(props, '$.k') AS INT) % 10 AS n_items
FROM events""",
    "v_outcomes": """
SELECT user_id AS run_id, event_id AS seq, event_type <> 'error' AS stored, event_type IN ('view', 'click') AS sales_ok,
       CASE event_type WHEN 'error' THEN 'db' WHEN 'signup' THEN 'api' END AS error_kind,
       CASE WHEN event_type IN ('error', 'signup') THEN concat('failure ', CAST(event_id AS VARCHAR)) END AS message
FROM events""",
    "v_batches": """
SELECT o_custkey AS run_id, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS batch_no,
       o_orderpriority = '5-LOW' AS fetch_failed, 100 AS returned, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 90 END AS stored
FROM orders""",
    "v_events": """
SELECT concat('B', lpad(CAST(user_id AS VARCHAR), 9, '0')) AS asin, event_id AS seq,
       CASE event_type WHEN 'view' THEN 'product_stored' WHEN 'click' THEN 'sales_stored' WHEN 'error' THEN 'product_store_failed'
                       WHEN 'signup' THEN 'product_not_found' ELSE 'sales_fetch_failed' END AS kind,
       ts AS at, concat('failure ', CAST(event_id AS VARCHAR)) AS error_text
FROM events""",
    "v_keywords": """
SELECT concat(lang, '/', CAST(doc_id AS VARCHAR)) AS id, lang AS country, source AS name,
       CAST(n_chars AS DECIMAL(38,10)) AS monthly_search_volume_exact,
       CAST(doc_id % 100 AS DECIMAL(38,10)) AS ease_of_ranking_score, doc_id
FROM documents""",
}

VIEW_BUILDERS = {
    "v_catalog": catalog, "v_status": status, "v_sales": sales, "v_sales_new": sales_new,
    "v_calls": calls, "v_outcomes": outcomes, "v_batches": batches, "v_events": status_events,
    "v_keywords": keywords,
}


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it needs (base views first, then
    ``extra`` CTEs in the given order)."""
    ctes = [f"{n} AS ({SQL_VIEWS[n].strip()})" for n in names]
    ctes += [f"{n} AS ({body.strip()})" for n, body in (extra or {}).items()]
    return ("WITH " + ",\n".join(ctes) + "\n" + sql.strip()) if ctes else sql.strip()


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sync requests as the service would receive them, one per order:
    key count, marketplace, mode, legacy flag, range and ISO date text
    (every tenth start date is written without zero padding)."""
    o = read_table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    unpadded = F.concat_ws("-", F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string"))
    pr = F.col("o_orderpriority")
    return o.select(
        k.alias("request_id"), (F.col("o_custkey") % 120).alias("n_keys"),
        F.when(k % 13 == 0, F.lit("")).otherwise(F.lit("us")).alias("marketplace"),
        F.when(pr == "1-URGENT", "fresh").when(pr == "2-HIGH", "resume").when(pr == "3-MEDIUM", "force")
        .when(pr == "5-LOW", "fresh").alias("sync_mode"),
        (k % 7 == 0).alias("force_resync"),
        F.when(F.col("o_orderstatus") == "F", "1month").when(F.col("o_orderstatus") == "O", "1year")
        .otherwise("6months").alias("date_range"),
        F.when(k % 10 == 0, unpadded).otherwise(F.date_format(d, "yyyy-MM-dd")).alias("start_date"),
        F.date_format(F.date_add(d, 30), "yyyy-MM-dd").alias("end_date"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested sales windows per product: first to last returned-item
    ship day (spans of days to years, leap days included)."""
    li = read_table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return li.groupBy(asin_of(F.col("l_partkey")).alias("asin")).agg(
        F.min("l_shipdate").cast("date").alias("start_date"), F.max("l_shipdate").cast("date").alias("end_date"))


SQL_VIEWS["v_requests"] = """
SELECT o_orderkey AS request_id, o_custkey % 120 AS n_keys,
       CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'us' END AS marketplace,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'fresh' WHEN '2-HIGH' THEN 'resume' WHEN '3-MEDIUM' THEN 'force'
                            WHEN '5-LOW' THEN 'fresh' END AS sync_mode,
       o_orderkey % 7 = 0 AS force_resync,
       CASE o_orderstatus WHEN 'F' THEN '1month' WHEN 'O' THEN '1year' ELSE '6months' END AS date_range,
       CASE WHEN o_orderkey % 10 = 0
            THEN concat_ws('-', CAST(year(o_orderdate) AS VARCHAR), CAST(month(o_orderdate) AS VARCHAR), CAST(day(o_orderdate) AS VARCHAR))
            ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS start_date,
       strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') AS end_date
FROM orders"""

SQL_VIEWS["v_spans"] = """
SELECT concat('B', lpad(CAST(l_partkey AS VARCHAR), 9, '0')) AS asin,
       CAST(min(l_shipdate) AS DATE) AS start_date, CAST(max(l_shipdate) AS DATE) AS end_date
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1"""

VIEW_BUILDERS.update({"v_requests": requests, "v_spans": spans})


# Every status event kind, in the order the all-kinds stand-in assigns them
# (event_id modulo 12).
ALL_EVENT_KINDS = ("fresh_reset", "resume", "key_added", "product_stored", "product_store_failed",
                   "product_not_found", "batch_fetch_failed", "sales_stored", "sales_fetch_failed",
                   "sales_all_failed", "status_set_clear", "key_removed")


def status_events_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status events of every kind (deletes, inserts and resets included),
    with the two flags ``status_set_clear`` carries."""
    e = read_table(spark, sf_dir, "events")
    kind = None
    for i, k in enumerate(ALL_EVENT_KINDS):
        cond = F.col("event_id") % len(ALL_EVENT_KINDS) == i
        kind = F.when(cond, k) if kind is None else kind.when(cond, k)
    return e.select(asin_of(F.col("user_id")).alias("asin"), F.col("event_id").alias("seq"),
                    kind.alias("kind"), F.col("ts").alias("at"),
                    F.concat(F.lit("failure "), F.col("event_id").cast("string")).alias("error_text"),
                    (F.col("value") > 10).alias("product_flag"), (F.col("value") > 25).alias("sales_flag"))


SQL_VIEWS["v_events_all"] = (
    "SELECT concat('B', lpad(CAST(user_id AS VARCHAR), 9, '0')) AS asin, event_id AS seq, CASE event_id % 12 "
    + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(ALL_EVENT_KINDS))
    + " END AS kind, ts AS \"at\", concat('failure ', CAST(event_id AS VARCHAR)) AS error_text,"
    " value > 10 AS product_flag, value > 25 AS sales_flag FROM events")
VIEW_BUILDERS["v_events_all"] = status_events_all
