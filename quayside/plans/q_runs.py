"""Whole runs over the stand-in tables: the status each key ends with, and the stop rule."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from quayside.plans.registry import query
from quayside.plans.runs import (NO_SALES_DOCUMENT, NO_SALES_POINT, STATUS, TOO_MANY_FAILURES, RunTargets, full_run)
from quayside.schemas import STATUS_TABLE
from quayside.session import ensure_checkpoint_dir
from quayside.sinks.publish import Target, publish_one, read_live
from quayside.sources import standin_docs as D
from quayside.sources import standins as S
from quayside.sources.standins import asin_of, with_views
from quayside.sources.tables import read_table

RUN_AT = dt.datetime(1999, 6, 1)  # inside the stand-in sales history


def _start(spark, sf):
    """Two fresh targets with the stand-in status on staging, as before a run."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex[:12]}"
    targets = RunTargets(Target(root, "dev_"), Target(root, "prod_"))
    publish_one(S.status(spark, sf).withColumn("updated_at", F.lit(None).cast("timestamp_ntz")), targets.staging, STATUS, "0")
    return targets


# The keys a fresh full run asks for, in batches; what landed for them; what their products and sales come to.
BASE = """
SELECT asin, has_product_data, has_sales_data, error FROM v_status WHERE asin NOT IN (SELECT asin FROM vis)
UNION ALL SELECT asin, false, false, NULL FROM vis"""
VISIBLE = "SELECT DISTINCT asin FROM v_catalog WHERE product_visibility AND asin IS NOT NULL AND asin <> ''"
TODO = """
SELECT asin, (row_number() OVER (ORDER BY asin) - 1) // {size} + 1 AS batch_no
FROM base WHERE NOT coalesce(has_product_data, false)"""
LANDED = f"SELECT {D.code_asin_sql()} AS asin, {D.dfa_sql()} AS first_day FROM part WHERE NOT {D.BROKEN_SQL}"


def _fetch_errors(spark, sf):
    """Every thousandth product request and every 29th sales request failed."""
    keys = read_table(spark, sf, "part").select("p_partkey", asin_of(F.col("p_partkey")).alias("asin"))
    text = F.concat(F.lit("HTTP 503 for "), "asin")
    return (keys.where("p_partkey % 1000 = 777").select(F.lit("product").alias("source"), "asin", text.alias("error_text"))
            .unionByName(keys.where("p_partkey % 29 = 0").select(F.lit("sales").alias("source"), "asin",
                                                                 text.alias("error_text"))))


@query("full_run_status", with_views(f"""
SELECT t.target, s.* FROM final s, (VALUES ('staging'), ('production')) t(target)""", "v_status", "v_catalog", extra={
    "vis": VISIBLE, "base": BASE, "todo": TODO.format(size=100), "landed": LANDED,
    "keys": "SELECT p_partkey AS k, concat('B', lpad(CAST(p_partkey AS VARCHAR), 9, '0')) AS asin FROM part",
    "broken": """SELECT batch_no, max(concat('HTTP 503 for ', asin)) AS text FROM todo JOIN keys USING (asin)
WHERE k % 1000 = 777 GROUP BY batch_no""",
    "fetched": """
SELECT b.asin, coalesce(b.has_product_data, false) OR (t.asin IS NOT NULL AND x.batch_no IS NULL AND l.asin IS NOT NULL) AS p,
       b.has_product_data, b.has_sales_data,
       CASE WHEN x.batch_no IS NOT NULL THEN x.text WHEN t.asin IS NOT NULL AND l.asin IS NOT NULL THEN NULL ELSE b.error END AS error
FROM base b LEFT JOIN todo t ON t.asin = b.asin LEFT JOIN broken x ON x.batch_no = t.batch_no
LEFT JOIN landed l ON l.asin = b.asin""",
    "points": """SELECT concat('B', lpad(CAST(l_partkey AS VARCHAR), 9, '0')) AS asin, count(*) FILTER (
    WHERE l_partkey % 50 <> 7 AND date_trunc('month', l_shipdate) BETWEEN DATE '1998-05-31' AND DATE '1999-05-31') AS n
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
    "final": f"""
SELECT f.asin, CASE WHEN p THEN true ELSE f.has_product_data END AS has_product_data,
       CASE WHEN NOT asked THEN f.has_sales_data ELSE NOT failed AND coalesce(n, 0) > 0 END AS has_sales_data,
       CASE WHEN NOT asked THEN error WHEN failed THEN concat('HTTP 503 for ', f.asin)
            WHEN n IS NULL THEN '{NO_SALES_DOCUMENT}' WHEN n = 0 THEN '{NO_SALES_POINT}' END AS error
FROM (SELECT *, p AND coalesce(NOT has_sales_data, false) AS asked FROM fetched) f
LEFT JOIN (SELECT asin, k % 29 = 0 AS failed FROM keys) USING (asin) LEFT JOIN points USING (asin)"""}))
def q_full_run_status(spark, sf):
    """Status of every key on both targets after a fresh full run: keys not found, batches and sales requests that
    failed, items without points, keys without a sales document."""
    targets = _start(spark, sf)
    full_run(spark, S.catalog(spark, sf), D.product_documents(spark, sf), D.sales_documents(spark, sf), targets, RUN_AT,
             "0001", "fresh", "1year", strict=False, fetch_errors=_fetch_errors(spark, sf))
    parts = [read_live(spark, t, STATUS, STATUS_TABLE).select(F.lit(name).alias("target"), "asin", "has_product_data",
                                                              "has_sales_data", "error")
             for name, t in (("staging", targets.staging), ("production", targets.production))]
    return parts[0].unionByName(parts[1])


@query("full_run_stopped", with_views(f"""
SELECT coalesce(stop_batch, total + 1) - 1 AS processed,
       (SELECT count(*) FROM judged WHERE stored AND batch_no < coalesce(stop_batch, total + 1)) AS product_ok,
       least(coalesce(stop_batch + 1, total), total) AS current_batch, total AS total_batches,
       stop_batch IS NOT NULL AS stopped,
       CASE WHEN stop_batch IS NULL THEN '' ELSE concat('{TOO_MANY_FAILURES} (batch ', stop_batch, ' of ', total, ')') END
           AS stop_reason
FROM (SELECT min(batch_no) FILTER (WHERE fails = 3) AS stop_batch, count(*) AS total FROM judged)""",
                                      "v_status", "v_catalog", extra={
    "vis": VISIBLE, "base": BASE, "todo": TODO.format(size=1), "landed": LANDED,
    "judged": """
SELECT batch_no, first_day IS NOT NULL AS stored,
       sum(CASE WHEN l.asin IS NOT NULL AND first_day IS NULL THEN 1 ELSE 0 END)
           OVER (ORDER BY batch_no ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS fails
FROM todo t LEFT JOIN landed l ON l.asin = t.asin"""}))
def q_full_run_stopped(spark, sf):
    """A full run of one-key batches whose product rows must hold a first day of sale: it stops at the third batch in a
    row that stores nothing."""
    no_sales = spark.createDataFrame([], "doc_id long, doc string")
    s = full_run(spark, S.catalog(spark, sf), D.product_documents(spark, sf), no_sales, _start(spark, sf), RUN_AT, "0001",
                 "fresh", wave_batches=500, batch_size=1, product_required=["asin", "date_first_available"])
    return s.select("processed", "product_ok", "current_batch", "total_batches", "stopped", "stop_reason")
