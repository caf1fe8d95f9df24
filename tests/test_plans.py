"""Physical-plan properties the scale design relies on."""

import datetime as dt
import os
import tempfile


import __spark_entry__ as E
from quayside.operators import batches, sales
from quayside.operators import upsert as ups
from quayside.session import ensure_checkpoint_dir

AS_OF = dt.datetime(2024, 2, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scratch(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    os.makedirs(base, exist_ok=True)
    return tempfile.mkdtemp(dir=base)


def test_selection_is_top_k_over_pruned_scans(spark, small_dir):
    p = plan(E.queries()["select_priority"](spark, small_dir))
    assert "TakeOrderedAndProject" in p and "Exchange rangepartitioning" not in p
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in p


def test_first_k_per_group_is_limited_before_the_shuffle(spark, small_dir):
    for name in ("error_summary", "keyword_topk_by_country"):
        p = plan(E.queries()[name](spark, small_dir))
        assert "WindowGroupLimit" in p and "Partial" in p, name


def test_dedupe_aggregates_partially(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "k string, seq int, v string")
    p = plan(batches.dedupe_last(df, ["k"], "seq"))
    assert "partial_max_by" in p


def test_key_filter_reaches_the_parquet_scan(spark):
    path = os.path.join(scratch(spark), "sales")
    spark.createDataFrame([("A", dt.date(2024, 1, 1), 3, 1.5)],
                          "asin string, date date, estimated_units_sold int, last_known_price double") \
        .selectExpr("*", "CAST(last_known_price AS DECIMAL(10,2)) AS p").drop("last_known_price") \
        .withColumnRenamed("p", "last_known_price").write.parquet(path)
    p = plan(sales.sales_summary(spark.read.parquet(path), asin="A"))
    assert "PushedFilters: [IsNotNull(asin), EqualTo(asin,A)]" in p


def test_touched_partitions_prune_the_scan_without_a_shuffle_on_them(spark):
    path = os.path.join(scratch(spark), "t")
    spark.createDataFrame([(f"k{i}", f"m{i % 12}", i) for i in range(240)], "k string, m string, v int") \
        .write.partitionBy("m").parquet(path)
    target = spark.read.parquet(path)
    src = spark.createDataFrame([("k1", "m1", 9), ("k2", "m2", 9)], "k string, m string, v int")
    touched = ups.upsert(target, src, ["k", "m"], update_cols=["v"], partition_by=["m"], touched_only=True,
                         on_duplicate="unique")
    p = plan(touched)
    import re
    flat = re.sub(r"#\d+", "", p)
    assert "PartitionFilters: [coalesce(m IN (m1,m2), false)]" in flat
    assert "hashpartitioning(m," not in flat  # the only shuffle is the merge on (k, m)
    assert touched.count() == 40


def test_batch_numbering_has_no_single_partition_shuffle_of_keys(spark):
    keys = spark.createDataFrame([(f"K{i:04d}",) for i in range(500)], "asin string")
    p = plan(batches.plan_batches(keys))
    # Only the per-partition count table goes through a single partition.
    assert p.count("Exchange SinglePartition") <= 1
    assert "Scan ExistingRDD" in p  # the checkpointed numbering


def test_fold_with_few_event_keys_does_not_shuffle_untouched_rows(spark, small_dir):
    import re
    p = re.sub(r"#\d+L?", "", plan(E.queries()["fold_status"](spark, small_dir)))
    assert "Union" in p  # touched rows joined, untouched rows passed through
    # The (size-checked) event keys are broadcast to split the status scan.
    assert "BroadcastHashJoin" in p and "LeftSemi" in p and "LeftAnti" in p
