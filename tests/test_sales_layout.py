"""The sales table's folders: what a merge reads and rewrites."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from quayside.operators import upsert as ups
from quayside.schemas import SALES_TABLE
from quayside.sinks import sales_layout as layout
from quayside.sinks.publish import Target, ensure_table, live_paths, publish, publish_one, read_live
from quayside.testing import assert_unique

AT = dt.datetime(2024, 2, 1)
NAME = "sales_estimate_data"


def _points(spark, n, units, first=0, months=3):
    rows = (spark.range(first, first + n).withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(months - 1)))))
    return rows.select(
        F.concat(F.lit("B"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("asin"), F.lit("us").alias("marketplace"),
        F.lit(False).alias("is_parent"), F.lit(False).alias("is_variant"), F.lit(True).alias("is_standalone"),
        F.lit(None).cast("string").alias("parent_asin"), F.add_months(F.lit("2024-01-15").cast("date"), -F.col("m")).alias("date"),
        F.lit(units).cast("int").alias("estimated_units_sold"), F.lit("9.50").cast("decimal(10,2)").alias("last_known_price"),
        F.lit(1).alias("seq"))


def _merge(spark, targets, points, version):
    live, dealt, by_folder = layout.merge_input(spark, targets, NAME, points)
    merged = ups.upsert_sales(live, dealt, AT, seq="seq")
    publish(merged.drop("action"), NAME, version, *targets, partition_by=layout.PART, merge_partitions=by_folder)
    return by_folder


def _folders(spark, target):
    return {p.rsplit("=", 1)[-1]: p for p in live_paths(spark, target, NAME)}


def test_only_touched_folders_are_rewritten(spark, tmp_path):
    targets = [Target(str(tmp_path), "dev_"), Target(str(tmp_path), "prod_")]
    for t in targets:
        ensure_table(spark, t, NAME, SALES_TABLE)
    assert _merge(spark, targets, _points(spark, 200, 1), "1") is False
    before = [_folders(spark, t) for t in targets]
    fresh = _points(spark, 3, 7, months=2).unionByName(_points(spark, 1, 8, first=900, months=1))
    expected = {r.part for r in layout.with_part(fresh).select("part").distinct().collect()}
    assert _merge(spark, targets, fresh, "2") is True
    for t, old in zip(targets, before):
        now = _folders(spark, t)
        assert set(now) == set(old) | expected
        assert {k for k in now if now[k] != old.get(k)} == expected
        got = read_live(spark, t, NAME, SALES_TABLE)
        assert got.columns == SALES_TABLE.fieldNames()
        assert_unique(got, ["asin", "marketplace", "date"])
        assert {(r.estimated_units_sold, r["count"]) for r in got.groupBy("estimated_units_sold").count().collect()} == \
            {(1, 594), (7, 6), (8, 1)}


def test_untouched_files_are_not_read(spark, tmp_path):
    target = Target(str(tmp_path), "dev_")
    _merge(spark, [target], _points(spark, 200, 1), "1")
    fresh = layout.with_part(_points(spark, 2, 5, months=1)).checkpoint(eager=True)
    touched = {r.part for r in fresh.select("part").distinct().collect()}
    last = max(k for k in _folders(spark, target) if k not in touched)
    for f in glob.glob(os.path.join(_folders(spark, target)[last].removeprefix("file:"), "*.parquet")):
        with open(f, "r+b") as fh:  # any task that opens this file fails
            fh.write(b"\0" * 64)
            fh.truncate(64)
    table = read_live(spark, target, NAME, layout.SCHEMA)
    got = layout.touched(table, fresh)
    assert "dynamicpruning" in got._jdf.queryExecution().toString()
    assert {r.part for r in got.select("part", "estimated_units_sold").distinct().collect()} == touched


def test_a_table_by_day_is_dealt_anew_once(spark, tmp_path):
    targets = [Target(str(tmp_path), "dev_"), Target(str(tmp_path), "prod_")]
    old = (_points(spark, 20, 1).drop("seq").withColumns({"rank": F.lit(None).cast("int"), "created_at": F.lit(AT).cast(
        "timestamp_ntz"), "updated_at": F.lit(AT).cast("timestamp_ntz")}))
    for t in targets:
        publish_one(old, t, NAME, "0", partition_by="date")
    assert _merge(spark, targets, _points(spark, 1, 4, months=1), "1") is False
    for t in targets:
        got = read_live(spark, t, NAME, SALES_TABLE)
        assert got.count() == 60 and got.where("estimated_units_sold = 4").count() == 1
        assert layout.is_dealt(spark, t, NAME)
    assert _merge(spark, targets, _points(spark, 1, 4, months=1).limit(0), "2") is True
    assert read_live(spark, targets[1], NAME, SALES_TABLE).count() == 60
    assert not layout.is_dealt(spark, targets[0], NAME, buckets=128)
