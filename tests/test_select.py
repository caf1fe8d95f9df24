import datetime as dt

import pytest

from quayside.operators import select as sel
from quayside.schemas import STATUS_TABLE

AS_OF = dt.datetime(2024, 2, 1)


def status_rows(spark, n_new, n_stale, extra=()):
    rows = []
    for i in range(n_new):
        rows.append((f"N{i:05d}", False, False, None, None, None, None, dt.datetime(2023, 1, 1) + dt.timedelta(hours=i), None))
    for i in range(n_stale):
        rows.append((f"S{i:05d}", True, False, None, dt.datetime(2023, 6, 1) + dt.timedelta(hours=i), None, None,
                     dt.datetime(2022, 1, 1), None))
    rows.extend(extra)
    return spark.createDataFrame(rows, STATUS_TABLE)


# Golden table of the reference: (new, stale) candidates -> (taken new, taken stale)
@pytest.mark.parametrize("n_new,n_stale,want_new,want_stale", [
    (120, 0, 100, 0), (60, 100, 60, 40), (0, 150, 0, 100), (30, 30, 30, 30), (0, 0, 0, 0)])
def test_priority_golden(spark, n_new, n_stale, want_new, want_stale):
    got = sel.select_priority(status_rows(spark, n_new, n_stale), AS_OF).collect()
    assert sum(r.is_new for r in got) == want_new
    assert sum(not r.is_new for r in got) == want_stale


def test_priority_equals_two_query_form(spark):
    st = status_rows(spark, 70, 80)
    one = [r.asin for r in sel.select_priority(st, AS_OF, 100).collect()]
    new = sel.select_new(st, AS_OF, 100).collect()
    stale = sel.select_stale(st, AS_OF, 100 - len(new)).collect()
    assert sorted(one) == sorted([r.asin for r in new] + [r.asin for r in stale])


def test_strict_thresholds_and_null_flags(spark):
    exactly_15 = AS_OF - dt.timedelta(days=15)
    exactly_30 = AS_OF - dt.timedelta(days=30)
    us = dt.timedelta(microseconds=1)
    extra = [
        ("A_at15", False, False, None, None, None, exactly_15, None, None),            # not < cut: held back
        ("A_before15", False, False, None, None, None, exactly_15 - us, None, None),   # eligible
        ("A_after15", False, False, None, None, None, exactly_15 + us, None, None),    # held back
        ("A_nullflag", None, False, None, None, None, None, None, None),              # NULL flag: never new
        ("B_at30", True, False, None, exactly_30, None, None, None, None),             # not stale
        ("B_before30", True, False, None, exactly_30 - us, None, None, None, None),    # stale
        ("B_nullsync", True, False, None, None, None, None, None, None),               # no sync time: not stale
    ]
    st = status_rows(spark, 0, 0, extra)
    new = {r.asin for r in sel.new_candidates(st, AS_OF).collect()}
    stale = {r.asin for r in sel.stale_candidates(st, AS_OF).collect()}
    assert new == {"A_before15"}
    assert stale == {"B_before30"}
    assert {r.asin for r in sel.needs_product(st).collect()} >= {"A_nullflag", "A_at15"}


def test_null_created_at_sorts_last(spark):
    extra = [("Z_null", False, False, None, None, None, None, None, None)]
    st = status_rows(spark, 3, 0, extra)
    got = [r.asin for r in sel.select_new(st, AS_OF, 3).collect()]
    assert "Z_null" not in got


def test_visible_and_cleanup(spark):
    cat = spark.createDataFrame([("A", True), ("A", True), ("B", False), (None, True), ("", True), ("C", True)],
                                "asin string, product_visibility boolean")
    vis = sel.visible_asins(cat)
    assert sorted(r.asin for r in vis.collect()) == ["A", "C"]
    st = status_rows(spark, 0, 0, [("A", True, True, None, None, None, None, None, None),
                                   ("B", True, True, None, None, None, None, None, None)])
    kept = {r.asin for r in sel.cleanup_kept(st, vis).collect()}
    deleted = {r.asin for r in sel.cleanup_deleted(st, vis).collect()}
    assert kept == {"A"} and deleted == {"B"}
    added = sel.add_new_keys(vis, st, AS_OF).collect()
    assert [(r.asin, r.has_product_data, r.has_sales_data) for r in added] == [("C", False, False)]


def test_stop_reasons(spark):
    from pyspark.sql import functions as F

    from quayside.operators import report
    df = spark.createDataFrame([(True, False), (False, False), (True, True)], "stopped boolean, sel_failed boolean")
    got = df.select(report.stop_reason("full", F.col("stopped")).alias("f"),
                    report.stop_reason("hourly", F.col("stopped"), selection_failed=F.col("sel_failed")).alias("h")
                    ).collect()
    assert [r.f for r in got] == [report.DEFAULT_STOP_REASON, "", report.DEFAULT_STOP_REASON]
    assert [r.h for r in got] == ["", "", report.SELECTION_FAILED_REASON]
