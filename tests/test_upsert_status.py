import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.operators import batches, status as st, upsert as ups
from quayside.schemas import STATUS_TABLE
from quayside.sources import standins
from quayside.testing import assert_unique

AS_OF = dt.datetime(2024, 2, 1)
T_SCHEMA = "k string, v int, created_at timestamp_ntz, updated_at timestamp_ntz"


def _t(spark, rows):
    return spark.createDataFrame(rows, T_SCHEMA)


def test_upsert_insert_update_keep(spark):
    old = dt.datetime(2023, 1, 1)
    target = _t(spark, [("a", 1, old, old), ("b", 2, old, old)])
    source = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    out = ups.upsert(target, source, ["k"], update_cols=["v"], keep_cols=["created_at"], touch_cols=["updated_at"],
                     insert_defaults={"created_at": F.lit(AS_OF).cast("timestamp_ntz")}, as_of=AS_OF,
                     on_duplicate="unique")
    got = {r.k: r for r in out.collect()}
    assert got["a"].v == 1 and got["a"].action == "unchanged" and got["a"].updated_at == old
    assert got["b"].v == 20 and got["b"].created_at == old and got["b"].updated_at == AS_OF
    assert got["c"].action == "inserted" and got["c"].created_at == AS_OF
    c = ups.upsert_counts(out).first()
    assert (c.inserted, c.updated) == (1, 1)


def test_upsert_idempotent_and_last_wins(spark):
    target = _t(spark, [("a", 1, None, None)])
    s1 = spark.createDataFrame([("a", 5, 1), ("a", 7, 2), ("x", 1, 1)], "k string, v int, seq int")
    once = ups.upsert(target, s1, ["k"], update_cols=["v"], seq="seq").drop("action")
    twice = ups.upsert(once, s1, ["k"], update_cols=["v"], seq="seq").drop("action")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.k: r.v for r in once.collect()} == {"a": 7, "x": 1}
    assert_unique(once, ["k"])


def test_upsert_null_keys_rejected_and_duplicates_error(spark):
    target = _t(spark, [])
    src = spark.createDataFrame([(None, 1), ("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(ups.DuplicateKeyError):
        ups.upsert(target, src, ["k"], update_cols=["v"], on_duplicate="error")
    ok = ups.upsert(target, src.filter("v <> 3"), ["k"], update_cols=["v"], on_duplicate="error").collect()
    assert ups.null_key_rows(src, ["k"]).count() == 1
    assert [r.k for r in ok] == ["a"]


def test_upsert_touched_partitions_only(spark):
    target = spark.createDataFrame([("a", "m1", 1), ("b", "m2", 2)], "k string, m string, v int")
    src = spark.createDataFrame([("a", "m1", 9)], "k string, m string, v int")
    full = ups.upsert(target, src, ["k", "m"], update_cols=["v"], partition_by=["m"], on_duplicate="unique")
    touched = ups.upsert(target, src, ["k", "m"], update_cols=["v"], partition_by=["m"], touched_only=True,
                         on_duplicate="unique")
    assert sorted((r.k, r.v) for r in full.collect()) == [("a", 9), ("b", 2)]
    assert [(r.k, r.v) for r in touched.collect()] == [("a", 9)]


def test_insert_ignore_existing_wins(spark):
    t = spark.createDataFrame([("a", "old")], "id string, name string")
    s = spark.createDataFrame([("a", "new"), ("b", "new")], "id string, name string")
    got = {r.id: r.name for r in ups.insert_ignore(t, s, ["id"], on_duplicate="unique").collect()}
    assert got == {"a": "old", "b": "new"}


def test_insert_ignore_first_of_the_source_wins(spark):
    t = spark.createDataFrame([("a", "old")], "id string, name string")
    s = spark.createDataFrame([("b", "second-zzz", 2), ("b", "first-aaa", 1)], "id string, name string, seq int")
    got = {r.id: r.name for r in ups.insert_ignore(t, s, ["id"], seq="seq").collect()}
    assert got == {"a": "old", "b": "first-aaa"}
    with pytest.raises(ValueError):
        ups.insert_ignore(t, s.drop("seq"), ["id"])


def _status(spark, rows):
    return spark.createDataFrame(rows, STATUS_TABLE)


EV = "asin string, seq long, kind string, at timestamp_ntz, error_text string"


def test_fold_sets_and_null_distinction(spark):
    t0 = dt.datetime(2024, 1, 1)
    s = _status(spark, [("A", False, False, "old error", None, None, None, t0, None)])
    ev = spark.createDataFrame([
        ("A", 1, "product_store_failed", t0 + dt.timedelta(hours=1), "boom"),
        ("A", 2, "product_stored", t0 + dt.timedelta(hours=2), None),
        ("A", 3, "resume", t0 + dt.timedelta(hours=3), None),
        ("Z", 1, "product_stored", t0, None)], EV)
    got = st.fold_status(s, ev).collect()
    assert len(got) == 1  # unknown key: no-op
    r = got[0]
    assert r.has_product_data is True and r.error is None
    assert r.product_data_synced_at == t0 + dt.timedelta(hours=2)
    assert r.updated_at == t0 + dt.timedelta(hours=2)  # resume does not stamp


def test_fold_order_independent(spark):
    t0 = dt.datetime(2024, 1, 1)
    s = _status(spark, [("A", None, None, None, None, None, None, t0, None)])
    rows = [("A", i, k, t0 + dt.timedelta(minutes=i), f"e{i}") for i, k in
            enumerate(["sales_stored", "product_not_found", "sales_fetch_failed", "product_stored"])]
    a = st.fold_status(s, spark.createDataFrame(rows, EV)).collect()
    b = st.fold_status(s, spark.createDataFrame(list(reversed(rows)), EV).repartition(3)).collect()
    assert a == b
    assert a[0].error is None and a[0].has_sales_data is False and a[0].product_fetch_attempted_at is not None


def test_fold_delete_and_reinsert(spark):
    t0 = dt.datetime(2024, 1, 1)
    s = _status(spark, [("A", True, True, None, t0, t0, None, t0, None), ("B", True, True, None, t0, t0, None, t0, None)])
    ev = spark.createDataFrame([
        ("A", 1, "key_removed", t0, None),
        ("A", 2, "sales_stored", t0, None),          # absent: no-op
        ("A", 3, "key_added", t0 + dt.timedelta(days=1), None),
        ("B", 1, "key_removed", t0, None),
        ("C", 1, "key_added", t0, None), ("C", 2, "key_added", t0 + dt.timedelta(days=1), None),
        ("D", 1, "fresh_reset", t0, None)], EV)
    got = {r.asin: r for r in st.fold_status(s, ev).collect()}
    assert set(got) == {"A", "C", "D"}
    assert got["A"].has_sales_data is False and got["A"].sales_estimate_data_synced_at is None
    assert got["A"].created_at == t0 + dt.timedelta(days=1)
    assert got["C"].created_at == t0  # second key_added is a no-op
    assert got["D"].has_product_data is False


def test_plan_batches_matches_row_number(spark):
    keys = spark.createDataFrame([(f"K{i:05d}",) for i in range(1234)], "asin string").repartition(7)
    got = sorted(batches.plan_batches(keys, num_partitions=5).collect())
    assert [r.position for r in got] == list(range(1, 1235))
    assert got[0].batch_no == 1 and got[99].batch_no == 1 and got[100].batch_no == 2 and got[-1].batch_no == 13
    assert {r.batch_count for r in got} == {13}


def test_stop_point_rules(spark):
    log = spark.createDataFrame([
        (1, 1, False, 100, 0), (1, 2, True, 0, 0), (1, 3, False, 100, 0), (1, 4, False, 100, 0),  # stop at 4
        (2, 1, False, 100, 0), (2, 2, False, 100, 5), (2, 3, False, 100, 0), (2, 4, False, 100, 0),  # reset
        (3, 1, False, 0, 0), (3, 2, False, 0, 0), (3, 3, False, 0, 0)],  # nothing returned: resets
        "run_id int, batch_no int, fetch_failed boolean, returned int, stored int")
    got = {r.run_id: r.stop_batch for r in batches.stop_point(log).collect()}
    assert got == {1: 4, 2: None, 3: None}


def _expected_stops(rows, limit=3):
    out = {}
    for run in sorted({r[0] for r in rows}):
        streak, stop = 0, None
        for _, b, ff, ret, sto in sorted(r for r in rows if r[0] == run):
            if ff:
                continue
            streak = streak + 1 if (ret > 0 and sto == 0) else 0
            if streak >= limit and stop is None:
                stop = b
        out[run] = stop
    return out


def test_stop_point_blocks_match_a_sequential_scan(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for run in range(12):
        for b in range(1, rnd.randint(1, 60)):
            rows.append((run, b, rnd.random() < 0.2, rnd.choice([0, 100, 100]), rnd.choice([0, 0, 0, 50])))
    df = spark.createDataFrame(rows, "run_id int, batch_no int, fetch_failed boolean, returned int, stored int")
    want = _expected_stops(rows)
    for bs in (1, 2, 3, 7, 1000):
        got = {r.run_id: r.stop_batch for r in batches.stop_point(df, block_size=bs).collect()}
        assert got == want, bs


def test_last_wins_needs_an_order(spark):
    target = _t(spark, [("a", 1, None, None)])
    src = spark.createDataFrame([("a", 5), ("a", 7)], "k string, v int")
    with pytest.raises(ValueError):
        ups.upsert(target, src, ["k"], update_cols=["v"])


def test_last_row_wins_not_the_greatest(spark):
    target = _t(spark, [])
    src = spark.createDataFrame([("a", 9, 1), ("a", 3, 2)], "k string, v int, seq int")
    assert [r.v for r in ups.upsert(target, src, ["k"], update_cols=["v"], seq="seq").collect()] == [3]


def test_variant_rows_can_be_upserted(spark):
    src = spark.sql("SELECT 'a' AS k, parse_json('{\"x\": 1}') AS v, 1 AS seq "
                    "UNION ALL SELECT 'a', parse_json('{\"x\": 2}'), 2")
    target = src.drop("seq").limit(0)
    out = ups.upsert(target, src, ["k"], update_cols=["v"], seq="seq").selectExpr("k", "to_json(v) AS v").collect()
    assert [tuple(r) for r in out] == [("a", '{"x":2}')]


def test_touched_split_by_two_columns(spark):
    target = spark.createDataFrame([(f"k{i}", f"m{i % 5}", i % 2, i) for i in range(50)], "k string, m string, n int, v int")
    src = spark.createDataFrame([("k1", "m1", 1, 100), ("k2", "m2", 0, 200), ("new", "m9", 7, 1)],
                                "k string, m string, n int, v int")
    inside, outside = ups.split_touched(target, src, ["m", "n"])
    assert inside.count() == 10 and outside.count() == 40
    out = ups.upsert(target, src, ["k", "m", "n"], update_cols=["v"], partition_by=["m", "n"], on_duplicate="unique")
    assert out.count() == 51


def test_key_hits_agree_with_merge_counts(spark):
    target = spark.createDataFrame([(f"k{i}", f"m{i % 3}", i) for i in range(30)], "k string, m string, v int")
    src = spark.createDataFrame([("k1", "m1", 0), ("k1", "m1", 5), ("k2", "m0", 1), ("z", "m2", 2), ("y", "m7", 3)],
                                "k string, m string, v int")
    hits = ups.key_hits(target, src, ["k", "m"], partition_by=["m"]).collect()
    c = ups.upsert_counts(ups.upsert(target, src.withColumn("seq", F.col("v")), ["k", "m"], update_cols=["v"],
                                     partition_by=["m"], seq="seq")).first()
    assert (sum(not r.hit for r in hits), sum(r.hit for r in hits)) == (c.inserted, c.updated) == (3, 1)


def test_key_hits_of_parts_of_one_table(spark):
    """One pass gives a flag per part, and rows that repeat a key or lack the condition's value count once."""
    target = spark.createDataFrame([("a", "m", 1), ("b", "m", 0), ("c", "m", None), ("a", "m", 0)], "k string, m string, v int")
    src = spark.createDataFrame([("a", "m"), ("a", "m"), ("b", "m"), ("c", "m"), ("d", "m"), (None, "m")], "k string, m string")
    hits = ups.key_hits(target, src, ["k", "m"], partition_by=["m"], hits={"all": F.lit(True), "sold": F.col("v") > 0})
    assert sorted(map(tuple, hits.collect())) == [
        ("a", "m", True, True), ("b", "m", True, False), ("c", "m", True, False), ("d", "m", False, False)]


def test_stand_in_sales_are_dealt_by_their_rows(spark, tmp_path, monkeypatch):
    """The tasks that group lines grow with the lines, and nothing is grouped before they are dealt."""
    lines = [(i % 40, dt.datetime(2000, 1 + i % 3, 5), "R", 1.0) for i in range(400)]
    spark.createDataFrame(lines, "l_partkey long, l_shipdate timestamp_ntz, l_returnflag string, l_quantity double").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    spark.range(40).selectExpr("id p_partkey", "2.5D p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(standins, "SALES_ROWS_PER_TASK", 20)
    got = standins.sales_new(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    above, _, below = plan.partition(", 20), REPARTITION_BY_NUM")
    assert "Aggregate" in above and "Join" in below and "Aggregate" not in below
    assert (got.count(), got.agg(F.sum("estimated_units_sold")).first()[0]) == (120, 400)


def test_fold_broadcast_key_path_equals_join_path(spark):
    t0 = dt.datetime(2024, 1, 1)
    s = _status(spark, [(f"K{i}", i % 2 == 0, None, None, None, None, None, t0, None) for i in range(20)])
    kinds = list(st.EVENT_RULES)
    ev = spark.createDataFrame([(f"K{i % 7}" if i % 5 else f"N{i}", i, kinds[i % len(kinds)],
                                 t0 + dt.timedelta(hours=i), f"e{i}") for i in range(40)], EV)
    fast = sorted(st.fold_status(s, ev).collect())
    slow = sorted(st.fold_status(s, ev, max_broadcast_keys=0).collect())
    assert fast == slow


def test_dealt_by_key_has_as_many_tasks_as_its_rows_need(spark):
    """Also where the rows compress so well that a size in bytes would give them all to one task."""
    rows = spark.range(0, 4000).select(F.lit("B1").alias("asin"), (F.col("id") % 1000).alias("n")).checkpoint(eager=True)
    dealt = ups.dealt_by_key(rows, ["asin", "n"], rows_per_task=500)
    placed = dealt.withColumn("task", F.spark_partition_id()).collect()
    sizes = [sum(r["task"] == t for r in placed) for t in range(8)]
    assert sum(sizes) == len(placed) == 4000 and 0 < min(sizes) and max(sizes) < 1000
    assert len({(r["n"], r["task"]) for r in placed}) == 1000  # the rows of a key share a task
    assert ups.dealt_by_key(rows.limit(0).checkpoint(eager=True), ["asin", "n"]).collect() == []
