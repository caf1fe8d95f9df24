import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quayside.functions import keys
from quayside.operators.validate import RejectedRowsError, split_valid_rows
from quayside.schemas import SALES_TABLE, USAGE_TABLE
from quayside.sinks import drift, publish
from quayside.sources import payloads
from quayside.streaming.landed import sync_landed_sales
from quayside.streaming.usage_stream import sync_usage
from quayside.session import ensure_checkpoint_dir

AS_OF = dt.datetime(2024, 2, 1)


def scratch(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    os.makedirs(base, exist_ok=True)
    return tempfile.mkdtemp(dir=base)


def sales_doc(asin, points, parent=""):
    return json.dumps({"data": [{"id": f"us/{asin}", "type": "sales", "attributes": {
        "asin": asin, "is_parent": False, "is_variant": True, "is_standalone": False, "parent_asin": parent,
        "data": [{"date": d, "estimated_units_sold": u, "last_known_price": p} for d, u, p in points]}}]})


def test_payload_files_quarantine_and_failfast(spark):
    d = scratch(spark)
    good = sales_doc("B1", [("2024-01-01", 3, 1.5)])
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write(good + "\n" + good[:-2] + ",]}\n" + '{"data": []}\n' + good.replace('"estimated_units_sold": 3', '"estimated_units_sold": 3.5') + "\n")
    parsed = payloads.read_payload_files(spark, d, "sales")
    s = {r.outcome for r in payloads.document_summary(parsed).collect()}
    assert s == {"ok", "parse_error", "empty_response"}
    assert payloads.quarantine(parsed).count() == 2
    with pytest.raises(Exception):
        payloads.read_payload_files(spark, d, "sales", mode="FAILFAST").collect()


def test_publish_roundtrip_retry_and_pointer(spark):
    root = scratch(spark)
    stg, prd = publish.Target(root, "dev_"), publish.Target(root, "prod_")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    rep = publish.publish(df, "t", "v1", stg, prd).collect()
    assert [r.status for r in rep] == ["ok", "ok"]
    df2 = spark.createDataFrame([(3, "c")], "id int, v string")
    publish.publish(df2, "t", "v2", stg, prd)
    publish.publish(df2, "t", "v2", stg, prd)  # retry of the same version is harmless
    assert [r.id for r in publish.read_live(spark, prd, "t").collect()] == [3]
    assert publish.ensure_table(spark, stg, "new", USAGE_TABLE) is True
    assert publish.ensure_table(spark, stg, "new", USAGE_TABLE) is False
    assert publish.read_live(spark, stg, "new", USAGE_TABLE).count() == 0


def test_publish_staging_failure_skips_production(spark):
    root = scratch(spark)
    stg = publish.Target("/proc/definitely/not/writable", "dev_")
    prd = publish.Target(root, "prod_")
    df = spark.createDataFrame([(1,)], "id int")
    rep = publish.publish(df, "t", "v1", stg, prd, on_error="log").collect()
    assert [r.status for r in rep] == ["failed"]
    assert publish.live_paths(spark, prd, "t") == []


def test_stream_replay_and_late_points(spark):
    root = scratch(spark)
    target = publish.Target(root, "dev_")
    publish.publish_one(spark.createDataFrame([], SALES_TABLE), target, "sales", "a0", partition_by="date")
    landing = os.path.join(root, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "1.json"), "w") as f:
        f.write(sales_doc("B1", [("2024-01-01", 3, 1.5), ("2024-01-02", 4, 1.5)]) + "\n")
    ck = os.path.join(root, "ck")
    sync_landed_sales(spark, landing, target, "sales", ck, AS_OF, schema=SALES_TABLE)
    with open(os.path.join(landing, "2.json"), "w") as f:  # a later document rewrites an old day
        f.write(sales_doc("B1", [("2024-01-01", 9, 2.0)]) + "\n")
    sync_landed_sales(spark, landing, target, "sales", ck, AS_OF, schema=SALES_TABLE)
    sync_landed_sales(spark, landing, target, "sales", ck, AS_OF, schema=SALES_TABLE)  # nothing new: no change
    got = {str(r.date): r.estimated_units_sold for r in publish.read_live(spark, target, "sales").collect()}
    assert got == {"2024-01-01": 9, "2024-01-02": 4}


def test_usage_stream_absolute_counts(spark):
    root = scratch(spark)
    target = publish.Target(root, "dev_")
    publish.publish_one(spark.createDataFrame([], USAGE_TABLE), target, "u", "a0")
    src = os.path.join(root, "calls")
    rows = [(i, dt.datetime(2024, 1, 1, 1 + i % 5), "product_database_query", 200, 1) for i in range(10)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, endpoint string, status int, n_items int") \
        .write.parquet(src)
    schema = spark.read.parquet(src).schema
    sync_usage(spark, spark.readStream.schema(schema).parquet(src), target, "u", os.path.join(root, "ck"))
    got = publish.read_live(spark, target, "u", USAGE_TABLE).collect()
    assert [(str(r.usage_date), r.call_count) for r in got] == [("2024-01-01", 10)]


def test_keys_unique_and_shaped(spark):
    df = spark.range(5000).select(F.concat(F.lit("B"), F.col("id").cast("string")).alias("k"))
    out = df.select(keys.surrogate_key(F.col("k"), "p").alias("a"), keys.surrogate_key(F.col("k"), "too long", 0).alias("b"),
                    keys.surrogate_key_32(F.col("k")).alias("c"),
                    keys.composite_key(F.lit("affiliate-long-id"), F.col("k"), F.lit(7)).alias("d"))
    rows = out.collect()
    assert len({r.a for r in rows}) == 5000
    assert all(len(r.a) == 9 and r.a[0] == "p" and r.b[0] == "x" and len(r.b) == 9 for r in rows)
    assert all(len(r.c) == 32 and r.c.isalnum() for r in rows)
    assert all(len(r.d) == 45 and r.d.startswith("agaffiliate-XB") for r in rows)


def test_validation_and_drift(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", None)], "asin string, d string")
    good, bad = split_valid_rows(df, ["asin", "d"])
    assert good.count() == 1 and bad.first().reject_reason == "d is null"
    with pytest.raises(RejectedRowsError):
        split_valid_rows(df, ["asin", "d"], strict=True)
    s = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v int")
    p = spark.createDataFrame([("a", 1), ("b", 3), ("d", 4), ("c", None)], "k string, v int")
    summ = drift.drift_summary(s, p, ["k"]).first()
    assert (summ.only_staging, summ.only_production, summ.differs, summ.same) == (0, 1, 1, 2)


def test_multi_line_documents(spark):
    d = scratch(spark)
    doc = json.dumps(json.loads(sales_doc("B9", [("2024-01-03", 1, 2.25)])), indent=2)
    for i in range(2):
        with open(os.path.join(d, f"{i}.json"), "w") as f:
            f.write(doc)
    parsed = payloads.read_payload_files(spark, d, "sales", multi_line=True)
    summary = payloads.document_summary(parsed).collect()
    assert [r.outcome for r in summary] == ["ok", "ok"]
    assert all(r.source_file.endswith(".json") for r in summary)


def test_text_documents_failfast(spark):
    docs = spark.createDataFrame([(1, sales_doc("B1", [("2024-01-01", 1, 1.0)])), (2, '{"data": [,]}')],
                                 "doc_id int, doc string")
    ok = payloads.parse_payloads(docs, "sales")
    assert payloads.quarantine(ok).count() == 1
    with pytest.raises(Exception):
        payloads.parse_payloads(docs, "sales", mode="FAILFAST").collect()


def test_drift_names_changed_columns(spark):
    s = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "k string, v int, w string")
    p = spark.createDataFrame([("a", 1, "y"), ("b", 3, "z")], "k string, v int, w string")
    got = {r.k: (r.drift, r.changed_columns) for r in drift.drift_rows(s, p, ["k"]).collect()}
    assert got == {"a": ("differs", "w"), "b": ("differs", "v,w")}


def _part(spark, rows):
    return spark.createDataFrame(rows, "k string, p string, v int")


def _read(spark, target, name="t"):
    return sorted((r.k, r.v) for r in publish.read_live(spark, target, name).collect())


def test_rerun_of_a_version_keeps_the_table_readable(spark):
    stg, prd = publish.Target(scratch(spark), "dev_"), publish.Target(scratch(spark), "prod_")
    publish.publish(_part(spark, [("a", "x", 1), ("b", "y", 2)]), "t", "1", stg, prd, partition_by="p")
    for version in ("2", "2", "0"):  # also an id that sorts before the others
        live = publish.read_live(spark, stg, "t")
        publish.publish(live.filter("p = 'x'").withColumn("v", F.col("v") + 10), "t", version, stg, prd,
                        partition_by="p", merge_partitions=True)
    assert _read(spark, stg) == _read(spark, prd) == [("a", 31), ("b", 2)]


def test_replaced_partition_that_ends_empty_is_dropped(spark):
    stg = publish.Target(scratch(spark), "dev_")
    publish.publish_one(_part(spark, [("a", "1", 1), ("b", "2", 2)]), stg, "t", "1", partition_by="p")
    publish.publish_one(_part(spark, []), stg, "t", "2", partition_by="p", merge_partitions=True, replaced={"1"})
    assert _read(spark, stg) == [("b", 2)]


def test_crash_between_write_and_pointer_changes_nothing(spark, monkeypatch):
    stg = publish.Target(scratch(spark), "dev_")
    publish.publish_one(_part(spark, [("a", "1", 1)]), stg, "t", "1", partition_by="p")
    with monkeypatch.context() as m:
        m.setattr(publish, "_write_pointer", lambda *a: (_ for _ in ()).throw(RuntimeError("driver died")))
        with pytest.raises(RuntimeError):
            publish.publish_one(_part(spark, [("a", "1", 9)]), stg, "t", "2", partition_by="p")
    assert _read(spark, stg) == [("a", 1)]
    # A pointer folder without its commit marker is skipped, and its number is not used again.
    os.makedirs(f"{stg.table('t')}/{publish.POINTER}/n=000000000007".removeprefix("file:"))
    assert _read(spark, stg) == [("a", 1)]
    publish.publish_one(_part(spark, [("a", "1", 5)]), stg, "t", "2", partition_by="p")
    assert _read(spark, stg) == [("a", 5)]


def test_old_versions_are_removed(spark):
    stg = publish.Target(scratch(spark), "dev_")
    publish.publish_one(_part(spark, [("a", "1", 0), ("z", "2", 0)]), stg, "t", "0", partition_by="p")
    for i in range(1, 14):
        publish.publish_one(_part(spark, [("a", "1", i)]), stg, "t", str(i), partition_by="p", merge_partitions=True)
    root = stg.table("t").removeprefix("file:")
    assert len(os.listdir(f"{root}/{publish.POINTER}")) == publish.KEEP_POINTERS
    # The folder of the untouched partition is old, but still named.
    assert len([n for n in os.listdir(root) if n.startswith(publish.LEVEL)]) == publish.KEEP_POINTERS + 1
    assert _read(spark, stg) == [("a", 13), ("z", 0)]


def test_once_applies_a_version_once(spark):
    stg, prd = publish.Target(scratch(spark), "dev_"), publish.Target(scratch(spark), "prod_")
    df = spark.createDataFrame([(1,)], "v int")
    publish.publish(df, "t", "1", stg, None, once=True)
    report = publish.publish(df.withColumn("v", F.lit(2)), "t", "1", stg, prd, once=True).collect()
    assert [r.v for r in publish.read_live(spark, prd, "t").collect()] == [1] and len(report) == 2
    assert publish.publish(df, "t", "1", stg, prd, once=True).first().status == "skipped"


def test_two_documents_in_one_batch_and_a_new_checkpoint(spark):
    root = scratch(spark)
    target = publish.Target(root, "dev_")
    publish.publish_one(spark.createDataFrame([], SALES_TABLE), target, "sales", "a0", partition_by="date")
    landing = os.path.join(root, "landing")
    os.makedirs(landing)
    for k, (name, units) in enumerate((("b.json", 9), ("a.json", 3))):  # the later file has the smaller name and value
        with open(os.path.join(landing, name), "w") as f:
            f.write(sales_doc("B1", [("2024-01-01", units, 1.5)]) + "\n" + '{"data": [,]}\n' + '{"data": []}\n'
                    + sales_doc("B2", [("not a date", 1, 1.0)]) + "\n")
        os.utime(os.path.join(landing, name), (1_700_000_000 + k, 1_700_000_000 + k))
    for ck in ("ck1", "ck1", "ck2"):
        sync_landed_sales(spark, landing, target, "sales", os.path.join(root, ck), AS_OF, schema=SALES_TABLE)
        got = [(r.asin, r.estimated_units_sold) for r in publish.read_live(spark, target, "sales").collect()]
        assert got == [("B1", 3)]
    rejects = publish.read_live(spark, target, "sales_rejects").filter("batch LIKE '%-0'")
    reasons = sorted(r.reason for r in rejects.dropDuplicates(["at", "reason", "detail"]).collect())
    assert reasons == ["date is null"] * 2 + ["empty_response"] * 2 + ["parse_error"] * 2


def test_usage_counts_calls_however_late(spark):
    root = scratch(spark)
    target = publish.Target(root, "dev_")
    publish.publish_one(spark.createDataFrame([], USAGE_TABLE), target, "u", "a0")
    src, ck = os.path.join(root, "calls"), os.path.join(root, "ck")
    kind = "event_id long, ts timestamp_ntz, endpoint string, status int, n_items int"
    for first, days in ((0, (10, 10)), (2, (11,)), (3, (5, 10))):
        spark.createDataFrame([(first + k, dt.datetime(2024, 1, d, 3), "e", 200, 1) for k, d in enumerate(days)], kind).write.mode("append").parquet(src)
        sync_usage(spark, spark.readStream.schema(kind).parquet(src), target, "u", ck)
    got = {r.usage_date.day: r.call_count for r in publish.read_live(spark, target, "u", USAGE_TABLE).collect()}
    assert got == {5: 1, 10: 3, 11: 1}


def test_drift_counts_columns_of_one_side(spark):
    s = spark.createDataFrame([("a", 1, "only here"), ("b", 1, None)], "k string, v int, w string")
    p = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    got = {r.k: r.changed_columns for r in drift.drift_rows(s, p, ["k"]).collect()}
    assert got == {"a": "w"}


def test_digest_is_cut_at_500_bytes(spark):
    from quayside.operators.report import error_digest_hourly
    texts = ["a" * 500, "a" * 501, "é" * 300, "a" + "é" * 300, "aa" + "€" * 200, "😀" * 130, "x" + "😀" * 130]
    df = spark.createDataFrame([(i, [t]) for i, t in enumerate(texts)], "run_id int, sample_errors array<string>")
    got = {r.run_id: r.sample_text for r in error_digest_hourly(df).collect()}
    for i, t in enumerate(texts):
        raw = t.encode()
        want = t if len(raw) <= 500 else raw[:500].decode(errors="ignore") + "..."
        assert got[i] == want, i


def test_drift_tree_equals_the_join_and_reads_only_differing_leaves(spark):
    at = dt.datetime(2024, 1, 1, 0, 0, 0, 5)
    kind = "k string, d date, v int, t timestamp_ntz, x array<string>, b binary"
    rows = [(f"k{i}", dt.date(2024, 1, 1 + i % 3), i if i % 5 else None, at, [f"a{i}", None], bytes([i % 256])) for i in range(300)]
    changed = list(rows)
    changed[7] = (*rows[7][:3], at + dt.timedelta(microseconds=1), *rows[7][4:])
    changed[20] = (*rows[20][:4], ["a20, null"], rows[20][5])
    changed[21] = (*rows[21][:5], b"\xff")
    changed[25] = (*rows[25][:2], 25, *rows[25][3:])
    changed[30] = ("new", *rows[30][1:])
    s, p = spark.createDataFrame(rows, kind), spark.createDataFrame(changed, kind)
    keys = ["k", "d"]
    want = sorted(map(tuple, drift.drift_rows(s, p, keys).collect()))
    assert len(want) == 6 and sorted(map(tuple, drift.drift_tree(s, p, keys).collect())) == want
    assert len(drift.differing_leaves(s, p, keys)) == 6
    # Order, partitions and a column of NULLs make no difference.
    assert drift.differing_leaves(s, s.repartition(7).withColumn("extra", F.lit(None).cast("int")), keys) == []
    assert drift.drift_tree(s, s, keys).collect() == []
    # A row twice is a difference although it cancels in an exclusive or.
    assert drift.differing_leaves(s, s.unionByName(s.limit(1)).unionByName(s.limit(1)), keys)
    assert drift.drift_tree(s.limit(0), s.limit(0), keys).collect() == []


def test_json_extract_of_odd_documents(spark):
    from quayside.operators.flatten import json_extract_cast
    texts = [None, "", "{broken", '{"data":[{"id":"a"}],}', "[]", '{"data":[]}', '{"data":[{"id":"us/a"}]}']
    got = {r.i: tuple(r)[1:] for r in json_extract_cast(spark.createDataFrame(list(enumerate(texts)), "i int, doc string")).collect()}
    none = (None, None, None, None)
    assert got == {0: none, 1: none, 2: none, 3: none, 4: none, 5: (None, None, None, 0), 6: ("us/a", None, None, 1)}
