"""Selection and clean-up queries (SEL-1..10, JN-1..4, SET-2)."""

from __future__ import annotations

from quayside.operators import select as sel
from quayside.plans.registry import query
from quayside.sources import standins as S
from quayside.sources.standins import AS_OF, with_views

RETRY_CUT = "TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 15 DAY"
STALE_CUT = "TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 30 DAY"
# At sf0.01 there are more new candidates than the default 100, so the
# registered priority query uses a larger run size to reach the stale fill.
PRIORITY_LIMIT = 500

NEW_WHERE = f"has_product_data = false AND (product_fetch_attempted_at IS NULL OR product_fetch_attempted_at < {RETRY_CUT})"
STALE_WHERE = f"has_product_data = true AND product_data_synced_at IS NOT NULL AND product_data_synced_at < {STALE_CUT}"

VISIBLE_SQL = "SELECT DISTINCT asin FROM v_catalog WHERE product_visibility AND asin IS NOT NULL AND asin <> ''"

# Two-query form of the priority selection, written independently of the
# one-plan Spark version: new up to the limit, then stale up to what is left.
PRIORITY_SQL = f"""
new_sel AS (SELECT asin, sales_estimate_data_synced_at FROM (
    SELECT *, row_number() OVER (ORDER BY created_at NULLS LAST, asin) AS rn FROM v_status WHERE {NEW_WHERE}) t
  WHERE rn <= {PRIORITY_LIMIT}),
stale_sel AS (SELECT asin, sales_estimate_data_synced_at FROM (
    SELECT *, row_number() OVER (ORDER BY product_data_synced_at, asin) AS rn FROM v_status WHERE {STALE_WHERE}) t
  WHERE rn <= {PRIORITY_LIMIT} - (SELECT count(*) FROM new_sel)),
selection AS (SELECT asin, true AS is_new, sales_estimate_data_synced_at FROM new_sel
              UNION ALL SELECT asin, false AS is_new, sales_estimate_data_synced_at FROM stale_sel)"""


def _prio_sql(tail: str, *views: str) -> str:
    body = with_views("SELECT 1", "v_status", *views)
    head = body[: body.rindex("\nSELECT 1")]
    return f"{head},{PRIORITY_SQL}\n{tail}"


@query("visible_asins", with_views(VISIBLE_SQL, "v_catalog"))
def q_visible_asins(spark, sf):
    return sel.visible_asins(S.catalog(spark, sf), ordered=True)


@query("select_new", with_views(f"""
SELECT asin, true AS is_new, sales_estimate_data_synced_at FROM v_status WHERE {NEW_WHERE}
ORDER BY created_at NULLS LAST, asin LIMIT 100""", "v_status"))
def q_select_new(spark, sf):
    return sel.select_new(S.status(spark, sf), AS_OF, 100)


@query("select_stale", with_views(f"""
SELECT asin, false AS is_new, sales_estimate_data_synced_at FROM v_status WHERE {STALE_WHERE}
ORDER BY product_data_synced_at, asin LIMIT 100""", "v_status"))
def q_select_stale(spark, sf):
    return sel.select_stale(S.status(spark, sf), AS_OF, 100)


@query("select_priority", _prio_sql("SELECT * FROM selection"))
def q_select_priority(spark, sf):
    """Flagship: the incremental run's key selection."""
    return sel.select_priority(S.status(spark, sf), AS_OF, PRIORITY_LIMIT)


@query("needs_product", with_views(
    "SELECT asin FROM v_status WHERE NOT coalesce(has_product_data, false)", "v_status"))
def q_needs_product(spark, sf):
    return sel.needs_product(S.status(spark, sf), ordered=True)


@query("needs_sales", with_views(
    "SELECT asin FROM v_status WHERE has_product_data = true AND has_sales_data = false", "v_status"))
def q_needs_sales(spark, sf):
    return sel.needs_sales(S.status(spark, sf), ordered=True)


@query("errored_asins", with_views("SELECT asin, error FROM v_status WHERE error IS NOT NULL", "v_status"))
def q_errored_asins(spark, sf):
    return sel.errored_asins(S.status(spark, sf))


@query("retry_backlog", with_views("""
SELECT asin, product_fetch_attempted_at, product_fetch_attempted_at + INTERVAL 15 DAY AS retry_after
FROM v_status WHERE has_product_data = false AND product_fetch_attempted_at IS NOT NULL""", "v_status"))
def q_retry_backlog(spark, sf):
    return sel.retry_backlog(S.status(spark, sf))


@query("cleanup_kept", with_views(f"""
SELECT * FROM v_status WHERE asin IN ({VISIBLE_SQL})""", "v_status", "v_catalog"))
def q_cleanup_kept(spark, sf):
    return sel.cleanup_kept(S.status(spark, sf), sel.visible_asins(S.catalog(spark, sf)))


@query("cleanup_deleted", with_views(f"""
SELECT * FROM v_status s WHERE NOT EXISTS (SELECT 1 FROM ({VISIBLE_SQL}) v WHERE v.asin = s.asin)""",
                                     "v_status", "v_catalog"))
def q_cleanup_deleted(spark, sf):
    return sel.cleanup_deleted(S.status(spark, sf), sel.visible_asins(S.catalog(spark, sf)))


@query("add_new_keys", with_views(f"""
SELECT asin, false AS has_product_data, false AS has_sales_data, CAST(NULL AS VARCHAR) AS error,
       CAST(NULL AS TIMESTAMP) AS product_data_synced_at, CAST(NULL AS TIMESTAMP) AS sales_estimate_data_synced_at,
       CAST(NULL AS TIMESTAMP) AS product_fetch_attempted_at,
       TIMESTAMP '2024-02-01 00:00:00' AS created_at, TIMESTAMP '2024-02-01 00:00:00' AS updated_at
FROM ({VISIBLE_SQL}) v WHERE asin NOT IN (SELECT asin FROM v_status)""", "v_status", "v_catalog"))
def q_add_new_keys(spark, sf):
    return sel.add_new_keys(sel.visible_asins(S.catalog(spark, sf)), S.status(spark, sf), AS_OF)


@query("not_found", _prio_sql("""
SELECT asin FROM selection EXCEPT SELECT asin FROM v_status WHERE has_product_data"""))
def q_not_found(spark, sf):
    """Requested = the run's selection; returned = keys with product data
    (the stand-in for the keys a response held)."""
    requested = sel.select_priority(S.status(spark, sf), AS_OF, PRIORITY_LIMIT)
    return sel.not_found(requested, S.status(spark, sf).filter("has_product_data"))


@query("attach_sync_info", _prio_sql("""
SELECT s.asin, s.is_new, s.sales_estimate_data_synced_at
FROM (SELECT DISTINCT asin FROM v_sales) t JOIN selection s ON s.asin = t.asin""", "v_sales"))
def q_attach_sync_info(spark, sf):
    selection = sel.select_priority(S.status(spark, sf), AS_OF, PRIORITY_LIMIT)
    stored = S.sales(spark, sf).select("asin").distinct()
    return sel.attach_sync_info(selection, stored)


KW_COLS = "id, country, name, monthly_search_volume_exact, ease_of_ranking_score, doc_id"


@query("keyword_topk", with_views(f"""
SELECT {KW_COLS} FROM v_keywords ORDER BY monthly_search_volume_exact DESC NULLS LAST, id LIMIT 10""", "v_keywords"))
def q_keyword_topk(spark, sf):
    return sel.keyword_topk(S.keywords(spark, sf), k=10)


@query("keyword_topk_by_country", with_views(f"""
SELECT * FROM (SELECT {KW_COLS}, row_number() OVER (PARTITION BY country
                 ORDER BY monthly_search_volume_exact DESC NULLS LAST, id) AS rank FROM v_keywords) t
WHERE rank <= 3""", "v_keywords"))
def q_keyword_topk_by_country(spark, sf):
    return sel.keyword_topk_by_country(S.keywords(spark, sf), k=3)
