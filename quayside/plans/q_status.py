"""Status fold queries (STA-1..12)."""

from __future__ import annotations

import datetime as dt

from quayside.operators import select as sel
from quayside.operators import status as st
from quayside.plans.q_select import VISIBLE_SQL
from quayside.plans.registry import query
from quayside.sources import standins as S
from quayside.sources.standins import AS_OF, with_views

NF = st.NOT_FOUND_ERROR
KINDS = "('product_stored', 'sales_stored', 'product_store_failed', 'product_not_found', 'sales_fetch_failed')"
FOLD_AGG = f"""
SELECT asin,
  arg_max({{'v': CASE kind WHEN 'product_stored' THEN true WHEN 'product_store_failed' THEN false ELSE true END}}, seq)
    FILTER (WHERE kind IN ('product_stored', 'product_store_failed', 'sales_fetch_failed')) AS hp,
  arg_max({{'v': kind = 'sales_stored'}}, seq) FILTER (WHERE kind IN ('sales_stored', 'sales_fetch_failed')) AS hs,
  arg_max({{'v': CASE WHEN kind IN ('product_stored', 'sales_stored') THEN NULL
                     WHEN kind = 'product_not_found' THEN '{NF}' ELSE error_text END}}, seq)
    FILTER (WHERE kind IN {KINDS}) AS er,
  arg_max({{'v': CASE WHEN kind = 'product_stored' THEN "at" END}}, seq)
    FILTER (WHERE kind IN ('product_stored', 'product_store_failed')) AS ps,
  arg_max({{'v': "at"}}, seq) FILTER (WHERE kind = 'sales_stored') AS ss,
  arg_max({{'v': "at"}}, seq) FILTER (WHERE kind = 'product_not_found') AS pa,
  arg_max("at", seq) AS upd
FROM v_events {{where}} GROUP BY asin"""
FOLD_SQL = """
SELECT s.asin,
  CASE WHEN a.hp IS NULL THEN s.has_product_data ELSE a.hp.v END AS has_product_data,
  CASE WHEN a.hs IS NULL THEN s.has_sales_data ELSE a.hs.v END AS has_sales_data,
  CASE WHEN a.er IS NULL THEN s.error ELSE a.er.v END AS error,
  CASE WHEN a.ps IS NULL THEN s.product_data_synced_at ELSE a.ps.v END AS product_data_synced_at,
  CASE WHEN a.ss IS NULL THEN s.sales_estimate_data_synced_at ELSE a.ss.v END AS sales_estimate_data_synced_at,
  CASE WHEN a.pa IS NULL THEN s.product_fetch_attempted_at ELSE a.pa.v END AS product_fetch_attempted_at,
  s.created_at, a.upd AS updated_at
FROM v_status s LEFT JOIN agg a ON s.asin = a.asin"""


def _folded(spark, sf):
    return st.fold_status(S.status(spark, sf), S.status_events(spark, sf))


@query("fold_status", with_views(FOLD_SQL, "v_status", "v_events", extra={"agg": FOLD_AGG.replace("{where}", "")}))
def q_fold_status(spark, sf):
    return _folded(spark, sf)


@query("stuck_stale", with_views(f"""
SELECT asin, product_data_synced_at, product_fetch_attempted_at FROM folded
WHERE has_product_data = true AND error = '{NF}' AND product_data_synced_at < TIMESTAMP '2024-03-02 00:00:00'""",
                                 "v_status", "v_events",
                                 extra={"agg": FOLD_AGG.replace("{where}", ""),
                                        "folded": FOLD_SQL}))
def q_stuck_stale(spark, sf):
    """Fold all events of the runs, then list the stale keys that stay stuck
    (not found again: flag kept, old sync time kept), two months later."""
    later = AS_OF + dt.timedelta(days=60)
    return st.stuck_stale(st.fold_status(S.status(spark, sf), S.status_events(spark, sf)), later)


@query("fresh_reset", with_views("""
SELECT coalesce(s.asin, v.asin) AS asin,
  CASE WHEN v.asin IS NULL THEN s.has_product_data ELSE false END AS has_product_data,
  CASE WHEN v.asin IS NULL THEN s.has_sales_data ELSE false END AS has_sales_data,
  CASE WHEN v.asin IS NULL THEN s.error END AS error,
  CASE WHEN v.asin IS NULL THEN s.product_data_synced_at END AS product_data_synced_at,
  CASE WHEN v.asin IS NULL THEN s.sales_estimate_data_synced_at END AS sales_estimate_data_synced_at,
  s.product_fetch_attempted_at,
  CASE WHEN s.asin IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE s.created_at END AS created_at,
  CASE WHEN v.asin IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' END AS updated_at
FROM v_status s FULL OUTER JOIN vis v ON s.asin = v.asin""", "v_status", "v_catalog", extra={"vis": VISIBLE_SQL}))
def q_fresh_reset(spark, sf):
    """Full run in mode fresh: every visible key is reset (inserted when
    missing); keys that are no longer visible are left alone."""
    events = st.fresh_reset_events(sel.visible_asins(S.catalog(spark, sf)), AS_OF)
    return st.fold_status(S.status(spark, sf), events)


# Independent formulation with row existence: find the last delete and the
# first insert after it, keep only the events that happen while the row
# exists, then take each column's last setter among those.
ALL_CTES = {
    "dl": "SELECT asin, max(seq) FILTER (WHERE kind = 'key_removed') AS del FROM v_events_all GROUP BY asin",
    "ins": """SELECT e.asin, min(e.seq) AS ins_seq, arg_min(e."at", e.seq) AS ins_at
              FROM v_events_all e JOIN dl d ON e.asin = d.asin
              WHERE e.kind IN ('fresh_reset', 'key_added') AND (d.del IS NULL OR e.seq > d.del) GROUP BY e.asin""",
    "st": """SELECT coalesce(s.asin, d.asin) AS asin, s.asin IS NOT NULL AS present, d.del, i.ins_seq, i.ins_at,
                    s.has_product_data, s.has_sales_data, s.error, s.product_data_synced_at,
                    s.sales_estimate_data_synced_at, s.product_fetch_attempted_at, s.created_at
             FROM v_status s FULL OUTER JOIN dl d ON s.asin = d.asin
             LEFT JOIN ins i ON i.asin = coalesce(s.asin, d.asin)""",
    "stt": """SELECT *, CASE WHEN del IS NOT NULL OR NOT present THEN ins_seq IS NOT NULL ELSE true END AS keep,
                     CASE WHEN del IS NOT NULL OR NOT present THEN ins_seq END AS start FROM st""",
    "eff": """SELECT e.* FROM v_events_all e JOIN stt t ON e.asin = t.asin
              WHERE t.keep AND (t.start IS NULL OR e.seq >= t.start)""",
    "agg": f"""SELECT asin,
  arg_max({{'v': CASE kind WHEN 'fresh_reset' THEN false WHEN 'product_stored' THEN true
                           WHEN 'product_store_failed' THEN false WHEN 'sales_fetch_failed' THEN true
                           WHEN 'status_set_clear' THEN product_flag END}}, seq)
    FILTER (WHERE kind IN ('fresh_reset', 'product_stored', 'product_store_failed', 'sales_fetch_failed',
                           'status_set_clear')) AS hp,
  arg_max({{'v': CASE kind WHEN 'fresh_reset' THEN false WHEN 'sales_stored' THEN true
                           WHEN 'sales_fetch_failed' THEN false WHEN 'status_set_clear' THEN sales_flag END}}, seq)
    FILTER (WHERE kind IN ('fresh_reset', 'sales_stored', 'sales_fetch_failed', 'status_set_clear')) AS hs,
  arg_max({{'v': CASE WHEN kind IN ('fresh_reset', 'product_stored', 'sales_stored', 'status_set_clear') THEN NULL
                     WHEN kind = 'product_not_found' THEN '{NF}' ELSE error_text END}}, seq)
    FILTER (WHERE kind NOT IN ('resume', 'key_added', 'key_removed')) AS er,
  arg_max({{'v': CASE WHEN kind = 'product_stored' THEN "at" END}}, seq)
    FILTER (WHERE kind IN ('fresh_reset', 'product_stored', 'product_store_failed')) AS ps,
  arg_max({{'v': CASE WHEN kind = 'sales_stored' THEN "at" END}}, seq)
    FILTER (WHERE kind IN ('fresh_reset', 'sales_stored')) AS ss,
  arg_max({{'v': "at"}}, seq) FILTER (WHERE kind = 'product_not_found') AS pa,
  arg_max("at", seq) FILTER (WHERE kind NOT IN ('resume', 'key_added', 'key_removed')) AS upd
FROM eff GROUP BY asin""",
}
ALL_SQL = """
SELECT t.asin,
  CASE WHEN a.hp IS NOT NULL THEN a.hp.v WHEN t.start IS NOT NULL THEN false ELSE t.has_product_data END AS has_product_data,
  CASE WHEN a.hs IS NOT NULL THEN a.hs.v WHEN t.start IS NOT NULL THEN false ELSE t.has_sales_data END AS has_sales_data,
  CASE WHEN a.er IS NOT NULL THEN a.er.v WHEN t.start IS NOT NULL THEN NULL ELSE t.error END AS error,
  CASE WHEN a.ps IS NOT NULL THEN a.ps.v WHEN t.start IS NOT NULL THEN NULL ELSE t.product_data_synced_at END
    AS product_data_synced_at,
  CASE WHEN a.ss IS NOT NULL THEN a.ss.v WHEN t.start IS NOT NULL THEN NULL ELSE t.sales_estimate_data_synced_at END
    AS sales_estimate_data_synced_at,
  CASE WHEN a.pa IS NOT NULL THEN a.pa.v WHEN t.start IS NOT NULL THEN NULL ELSE t.product_fetch_attempted_at END
    AS product_fetch_attempted_at,
  CASE WHEN t.start IS NOT NULL THEN t.ins_at ELSE t.created_at END AS created_at,
  CASE WHEN a.upd IS NOT NULL THEN a.upd WHEN t.start IS NOT NULL THEN t.ins_at END AS updated_at
FROM stt t LEFT JOIN agg a ON t.asin = a.asin WHERE t.keep"""


@query("fold_status_all_kinds", with_views(ALL_SQL, "v_status", "v_events_all", extra=ALL_CTES))
def q_fold_status_all_kinds(spark, sf):
    """Every event kind (STA-1..12): resets, inserts, deletes, flag sets."""
    return st.fold_status(S.status(spark, sf), S.status_events_all(spark, sf))
