"""End-to-end incremental and full runs on the smallest stand-in tables."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quayside.plans.runs import (NO_SALES_DOCUMENT, PRODUCT_TABLE, REJECTS, SALES, STATUS, USAGE, RunTargets, full_run,
                                 incremental_run)
from quayside.operators.status import status_bucket
from quayside.operators.validate import RejectedRowsError
from quayside.schemas import SALES_TABLE, STATUS_TABLE, USAGE_TABLE
from quayside.session import ensure_checkpoint_dir
from quayside.sinks.publish import Target, ensure_table, live_paths, publish_one, read_live
from quayside.sources import standin_docs as D
from quayside.sources import standins as S

AS_OF = dt.datetime(2024, 2, 1)


def _targets(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    os.makedirs(base, exist_ok=True)
    root = tempfile.mkdtemp(dir=base)
    t = RunTargets(Target(root, "dev_"), Target(root, "prod_"))
    return t


def _seed(spark, sf, t):
    status = S.status(spark, sf).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    publish_one(status, t.staging, STATUS, "0000")
    for tgt in (t.staging, t.production):
        ensure_table(spark, tgt, SALES, SALES_TABLE, "0000")
        ensure_table(spark, tgt, USAGE, USAGE_TABLE, "0000")


def test_incremental_run(spark, small_dir):
    t = _targets(spark)
    _seed(spark, small_dir, t)
    summary = incremental_run(spark, S.catalog(spark, small_dir), D.product_documents(spark, small_dir),
                              D.sales_documents(spark, small_dir), S.calls(spark, small_dir), t, AS_OF,
                              "0001").first()
    assert 0 < summary.processed <= 100
    assert summary.new_asins + summary.stale_asins == summary.processed
    assert summary.product_ok + summary.failed == summary.processed
    status = read_live(spark, t.staging, STATUS, STATUS_TABLE)
    stored = read_live(spark, t.staging, PRODUCT_TABLE)
    assert stored.count() == summary.product_ok
    # Stored keys are marked; status goes to staging only.
    marked = status.join(stored.select("asin"), "asin").filter("has_product_data AND product_data_synced_at = "
                                                                "TIMESTAMP_NTZ'2024-02-01 00:00:00'")
    assert marked.count() == summary.product_ok
    assert live_paths(spark, t.production, STATUS) == []
    assert read_live(spark, t.production, PRODUCT_TABLE).count() == summary.product_ok
    # Keys no longer visible were removed.
    vis = S.catalog(spark, small_dir).filter("product_visibility").select("asin")
    assert status.join(vis, "asin", "left_anti").count() == 0


def test_full_run(spark, small_dir):
    t = _targets(spark)
    _seed(spark, small_dir, t)
    summary = full_run(spark, S.catalog(spark, small_dir), D.product_documents(spark, small_dir),
                       D.sales_documents(spark, small_dir), t, AS_OF, "0001", "fresh", "1year", strict=False).first()
    assert summary.processed > 0 and summary.product_ok <= summary.processed
    # Full runs publish status to both targets.
    assert read_live(spark, t.production, STATUS, STATUS_TABLE).count() == \
        read_live(spark, t.staging, STATUS, STATUS_TABLE).count()
    sales = read_live(spark, t.staging, SALES, SALES_TABLE)
    lo, hi = sales.agg(F.min("date"), F.max("date")).first()
    assert lo is None or (lo >= dt.date(2023, 1, 31) and hi <= dt.date(2024, 1, 31))


def test_incremental_run_moves_sales(spark, small_dir):
    """Run dated inside the stand-in sales history so the windows hold points."""
    t = _targets(spark)
    _seed(spark, small_dir, t)
    as_of = dt.datetime(1999, 6, 1)
    summary = incremental_run(spark, S.catalog(spark, small_dir), D.product_documents(spark, small_dir),
                              D.sales_documents(spark, small_dir), S.calls(spark, small_dir), t, as_of,
                              "0001").first()
    sales = read_live(spark, t.staging, SALES, SALES_TABLE)
    assert summary.sales_ok > 0 and sales.count() > 0
    # Bad points are kept with their reason, never written.
    rejects = read_live(spark, t.staging, REJECTS).groupBy("source").count().collect()
    kept = {r["source"]: r["count"] for r in rejects}
    assert summary.rejected_points == kept.get("sales_point", 0)
    assert summary.rejected_documents == kept["product"] + kept.get("sales", 0) > 0
    assert summary.run_class == "yellow"
    assert sales.filter("date IS NULL OR estimated_units_sold IS NULL").count() == 0
    lo, hi = sales.agg(F.min("date"), F.max("date")).first()
    assert lo >= dt.date(1998, 5, 31) and hi <= dt.date(1999, 5, 31)
    assert read_live(spark, t.production, SALES, SALES_TABLE).count() == sales.count()
    st = read_live(spark, t.staging, STATUS, STATUS_TABLE)
    assert st.filter("has_sales_data AND sales_estimate_data_synced_at = TIMESTAMP_NTZ'1999-06-01 00:00:00'") \
        .count() == summary.sales_ok


def test_second_incremental_run_rewrites_only_touched_status_buckets(spark, small_dir):
    from quayside.sinks.publish import live_pointer
    from quayside.testing import assert_unique
    t = _targets(spark)
    _seed(spark, small_dir, t)
    args = (S.catalog(spark, small_dir), D.product_documents(spark, small_dir), D.sales_documents(spark, small_dir),
            S.calls(spark, small_dir), t)
    incremental_run(spark, *args, AS_OF, "0001", status_buckets=16)  # unbucketed -> one full bucketed write
    first = read_live(spark, t.staging, STATUS, STATUS_TABLE)
    n_first = first.count()
    s2 = incremental_run(spark, *args, AS_OF + dt.timedelta(hours=1), "0002", status_buckets=16).first()
    status = read_live(spark, t.staging, STATUS, STATUS_TABLE)
    assert_unique(status, ["asin"])
    assert status.count() == n_first + s2.added - s2.cleaned_up
    ptr = live_pointer(spark, t.staging, STATUS).collect()
    assert len(ptr) == 16 and all("/bucket_16=" in r.table_name for r in ptr)
    rewritten = {r.part_value for r in ptr if "=0002-" in r.table_name}
    touched = status.filter("updated_at = TIMESTAMP_NTZ'2024-02-01 01:00:00'").select(
        status_bucket(F.col("asin"), 16).cast("string").alias("b")).distinct()
    assert rewritten >= {r.b for r in touched.collect()} and rewritten


def test_repeated_run_changes_nothing(spark, small_dir):
    t = _targets(spark)
    _seed(spark, small_dir, t)
    args = (S.catalog(spark, small_dir), D.product_documents(spark, small_dir), D.sales_documents(spark, small_dir),
            S.calls(spark, small_dir), t, dt.datetime(1999, 6, 1), "0001")
    names = ((PRODUCT_TABLE, None), (SALES, SALES_TABLE), (USAGE, USAGE_TABLE))

    def tables():
        return [sorted(map(str, read_live(spark, t.production, n, k).drop("created_at", "updated_at").collect()))
                for n, k in names]

    incremental_run(spark, *args)
    usage = sorted(map(str, read_live(spark, t.staging, USAGE, USAGE_TABLE).collect()))
    sales = tables()[1]
    incremental_run(spark, *args)
    assert sorted(map(str, read_live(spark, t.staging, USAGE, USAGE_TABLE).collect())) == usage
    assert set(sales) <= set(tables()[1])  # the second run selects further keys
    assert read_live(spark, t.staging, STATUS, STATUS_TABLE).count() > 0


def _sales_doc(asin, points):
    return json.dumps({"data": [{"id": f"us/{asin}", "type": "sales", "attributes": {
        "asin": asin, "is_parent": False, "is_variant": True, "is_standalone": False, "parent_asin": "",
        "data": [{"date": d, "estimated_units_sold": u, "last_known_price": 1.5} for d, u in points]}}]})


def test_resume_takes_keys_with_earlier_products(spark):
    """One key has product data and no sales; its document landed twice, the later one smaller."""
    t = _targets(spark)
    row = {"asin": "B1", "has_product_data": True, "has_sales_data": False}
    publish_one(spark.createDataFrame([tuple(row.get(c) for c in STATUS_TABLE.fieldNames())], STATUS_TABLE),
                t.staging, STATUS, "0")
    catalog = spark.createDataFrame([("B1", True)], "asin string, product_visibility boolean")
    docs = spark.createDataFrame([(1, _sales_doc("B1", [("2024-01-30", 9)])), (2, _sales_doc("B1", [("2024-01-30", 3)]))],
                                 "line int, doc string")
    none = spark.createDataFrame([], "line int, doc string")
    calls = spark.createDataFrame([(1, dt.datetime(2024, 1, 31), "sales_estimates_query", 200, 1)],
                                  "event_id long, ts timestamp_ntz, endpoint string, status int, n_items int")
    s = full_run(spark, catalog, none, docs, t, AS_OF, "0001", "resume", calls=calls).first()
    assert (s.processed, s.sales_todo, s.sales_ok, s.failed) == (0, 1, 1, 0)
    assert [r.estimated_units_sold for r in read_live(spark, t.production, SALES, SALES_TABLE).collect()] == [3]
    assert read_live(spark, t.production, STATUS, STATUS_TABLE).first().has_sales_data
    assert read_live(spark, t.production, USAGE, USAGE_TABLE).first().call_count == 1


def test_full_run_names_failed_keys_and_stops_on_bad_rows(spark):
    t = _targets(spark)
    rows = [("B1", True, False), ("B2", True, False), ("B3", False, False)]
    publish_one(spark.createDataFrame([tuple({"asin": a, "has_product_data": p, "has_sales_data": s}.get(c)
                                             for c in STATUS_TABLE.fieldNames()) for a, p, s in rows], STATUS_TABLE),
                t.staging, STATUS, "0")
    catalog = spark.createDataFrame([(a, True) for a, _, _ in rows], "asin string, product_visibility boolean")
    docs = spark.createDataFrame([(1, _sales_doc("B1", [("no date", 1), ("2024-01-30", 2)]))], "line int, doc string")
    none = spark.createDataFrame([], "line int, doc string")
    with pytest.raises(RejectedRowsError):
        full_run(spark, catalog, none, docs, t, AS_OF, "0001", "resume")
    s = full_run(spark, catalog, none, docs, t, AS_OF, "0001", "resume", strict=False).first()
    assert (s.processed, s.product_ok, s.sales_ok, s.rejected_points, s.run_class) == (1, 0, 1, 1, "yellow")
    errors = {r.asin: r.error for r in read_live(spark, t.staging, STATUS, STATUS_TABLE).collect()}
    assert errors["B1"] is None and errors["B2"] == NO_SALES_DOCUMENT and errors["B3"] is None
