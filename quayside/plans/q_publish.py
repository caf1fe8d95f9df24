"""Publishing, pointer reads, drift and row validation queries (SNK-1..5, SRC-4/5, JN-8)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quayside.operators import status as st
from quayside.operators import upsert as ups
from quayside.operators.validate import mark_valid_rows
from quayside.operators import flatten as flt
from quayside.plans.q_flatten import _sales_docs
from quayside.plans.q_status import FOLD_AGG, FOLD_SQL
from quayside.plans.q_upsert import SALES_TARGET_SQL, UPSERT_SALES_SQL, sales_target
from quayside.plans.registry import query
from quayside.schemas import SALES_REQUIRED
from quayside.session import ensure_checkpoint_dir
from quayside.sinks import drift, publish
from quayside.sources import standin_docs as D
from quayside.sources import standins as S
from quayside.sources.standins import AS_OF, with_views


def _targets(spark):
    """A fresh staging/production pair under the shared checkpoint folder."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/publish-{uuid.uuid4().hex[:12]}"
    return publish.Target(root, "dev_"), publish.Target(root, "prod_")


@query("src_pointer_catalog", with_views("SELECT * FROM v_catalog", "v_catalog"))
def q_src_pointer_catalog(spark, sf):
    """Publish the catalog, then read it back the way the reference finds
    its live catalog: through the pointer table."""
    staging, _ = _targets(spark)
    publish.publish_one(S.catalog(spark, sf), staging, "catalog", "20240201T000000")
    return publish.read_live(spark, staging, "catalog")


MERGED_SQL = {"tgt": SALES_TARGET_SQL, "m": UPSERT_SALES_SQL}


def _publish_twice(spark, sf, versions):
    """The stored sales table, published to staging and production and
    partitioned by month; then the fresh points merged in under each of
    ``versions``. Read back from production."""
    staging, production = _targets(spark)
    stored = sales_target(spark, sf)
    publish.publish(stored, "sales", "v0001", staging, production, partition_by="date")
    fresh = S.sales_new(spark, sf).checkpoint(eager=True)  # every merge reads it twice
    for version in versions:
        live = publish.read_live(spark, staging, "sales").select(*stored.columns)
        touched = ups.upsert_sales(live, fresh, AS_OF, partition_by=["date"], touched_only=True,
                                   on_duplicate="unique").drop("action")
        publish.publish(touched, "sales", version, staging, production, partition_by="date", merge_partitions=True)
    return publish.read_live(spark, production, "sales").select(*stored.columns)


@query("publish_roundtrip", with_views("SELECT * EXCLUDE (action) FROM m", "v_sales", "v_sales_new", extra=MERGED_SQL))
def q_publish_roundtrip(spark, sf):
    """Version 2 merges the fresh points; only the touched months are
    rewritten and the pointer keeps the other months' folders."""
    return _publish_twice(spark, sf, ["v0002"])


@query("publish_rerun", with_views("SELECT * EXCLUDE (action) FROM m", "v_sales", "v_sales_new", extra=MERGED_SQL))
def q_publish_rerun(spark, sf):
    """The same version published again, and once more under an id that
    sorts before it: every write has its own folder and the newest pointer is
    live, so the table is that of one merge."""
    return _publish_twice(spark, sf, ["v0002", "v0002", "a0001"])


def _status_pair(spark, sf):
    """Staging status after the incremental run's events (status updates go
    to staging only) vs the production copy, which did not get them."""
    staging = st.fold_status(S.status(spark, sf), S.status_events(spark, sf))
    production = S.status(spark, sf).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    return staging, production


DRIFT_BASE = {"agg": FOLD_AGG.replace("{where}", ""), "stg": FOLD_SQL,
              "prd": "SELECT *, CAST(NULL AS TIMESTAMP) AS updated_at FROM v_status"}
STATUS_COLS = ["has_product_data", "has_sales_data", "error", "product_data_synced_at",
               "sales_estimate_data_synced_at", "product_fetch_attempted_at", "created_at", "updated_at"]
DIFF_LIST = ", ".join(f"CASE WHEN s.{c} IS DISTINCT FROM p.{c} THEN '{c}' END" for c in STATUS_COLS)
DRIFT_SQL = f"""
SELECT coalesce(s.asin, p.asin) AS asin,
  CASE WHEN p.asin IS NULL THEN 'only_staging' WHEN s.asin IS NULL THEN 'only_production'
       WHEN {" OR ".join(f"s.{c} IS DISTINCT FROM p.{c}" for c in STATUS_COLS)} THEN 'differs' ELSE 'same' END AS drift,
  CASE WHEN p.asin IS NOT NULL AND s.asin IS NOT NULL AND ({" OR ".join(f"s.{c} IS DISTINCT FROM p.{c}" for c in STATUS_COLS)})
       THEN concat_ws(',', {DIFF_LIST}) END AS changed_columns
FROM stg s FULL OUTER JOIN prd p ON s.asin = p.asin"""
DRIFT_BASE["d"] = DRIFT_SQL


@query("drift_rows", with_views("SELECT * FROM d WHERE drift <> 'same'", "v_status", "v_events", extra=DRIFT_BASE))
def q_drift_rows(spark, sf):
    s, p = _status_pair(spark, sf)
    return drift.drift_rows(s, p, ["asin"])


@query("drift_tree", with_views("SELECT * FROM d WHERE drift <> 'same'", "v_status", "v_events", extra=DRIFT_BASE))
def q_drift_tree(spark, sf):
    """The same rows, found by comparing digests of key buckets from the root down."""
    s, p = _status_pair(spark, sf)
    return drift.drift_tree(s, p, ["asin"])


@query("drift_summary", with_views("""
SELECT CAST(count_if(drift = 'only_staging') AS BIGINT) AS only_staging, CAST(count_if(drift = 'only_production') AS BIGINT) AS only_production,
       CAST(count_if(drift = 'differs') AS BIGINT) AS differs, CAST(count_if(drift = 'same') AS BIGINT) AS same FROM d""",
                                   "v_status", "v_events", extra=DRIFT_BASE))
def q_drift_summary(spark, sf):
    s, p = _status_pair(spark, sf)
    return drift.drift_summary(s, p, ["asin"])


@query("split_valid_rows", "WITH pts AS (" + D.SALES_POINTS_SQL + ")\nSELECT *, "
       + " ".join(["CASE"] + [f"WHEN {c} IS NULL THEN '{c} is null'" for c in
                             ("asin", "marketplace", "is_parent", "is_variant", "is_standalone", "date",
                              "estimated_units_sold", "last_known_price")] + ["END"])
       + " AS reject_reason FROM (" + D.sales_rows_sql(first_item_only=True) + ") r")
def q_split_valid_rows(spark, sf):
    """Flat sales rows checked against the NOT NULL columns of the sales
    table; rejected rows carry the reason (the good ones are written)."""
    rows = flt.flatten_sales(_sales_docs(spark, sf), marketplace="us", first_item_only=True)
    return mark_valid_rows(rows, list(SALES_REQUIRED) + ["estimated_units_sold", "last_known_price"])
