"""Collision-free keys, column defaults, counts observed while writing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quayside.functions import keys
from quayside.operators import upsert as ups
from quayside.operators.unique_keys import KeySpaceFull, duplicate_values, unique_keys
from quayside.schemas import SALES_TABLE
from quayside.sinks import defaults, publish
from tests.test_io import scratch


def natural(spark, names):
    return spark.createDataFrame([(n,) for n in names], "k string")


def drawn(df):
    return {r.k: r.v for r in df.collect()}


def test_unique_keys_redraw_only_what_collides(spark):
    names = [f"n{i}" for i in range(200)]
    first = {n: r for n, r in natural(spark, names).select("k", keys.encoded(F.col("k"), 2)).collect()}
    table = unique_keys(natural(spark, names + names[:50] + [None]), "k", "v", lambda k: keys.encoded(k, 2))
    got = drawn(table)
    assert sorted(got) == sorted(names) and len(set(got.values())) == 200 and duplicate_values(table, "v").isEmpty()
    for value in set(first.values()):
        assert got[min(n for n in names if first[n] == value)] == value
    assert len(set(first.values())) < 200  # some did collide
    # The same again, in another order and partitioning.
    assert drawn(unique_keys(natural(spark, names[::-1]).repartition(7), "k", "v", lambda k: keys.encoded(k, 2))) == got


def test_unique_keys_forced_to_collide(spark):
    """Eight characters that all first draws share."""
    same = lambda k: F.when(F.contains(k, F.lit("~")), keys.encoded(k, 8)).otherwise(F.lit("aaaaaaaa"))
    got = drawn(unique_keys(natural(spark, [f"n{i}" for i in range(50)]), "k", "v", same))
    assert len(set(got.values())) == 50 and got["n0"] == "aaaaaaaa"


def test_unique_keys_keep_existing_values(spark):
    old = drawn(unique_keys(natural(spark, ["m", "z"]), "k", "v", lambda k: F.lit("a") if k is None else keys.encoded(k, 1)))
    kept = spark.createDataFrame(list(old.items()), "k string, v string")
    got = drawn(unique_keys(natural(spark, ["a", "b", "m", "c"]), "k", "v", lambda k: keys.encoded(k, 1), existing=kept))
    assert sorted(got) == ["a", "b", "c", "m", "z"] and got["m"] == old["m"] and got["z"] == old["z"]
    assert len(set(got.values())) == 5


def test_unique_keys_full_space(spark, monkeypatch):
    from quayside.operators import unique_keys as module
    monkeypatch.setattr(module, "MAX_ROUNDS", 3)
    with pytest.raises(KeySpaceFull):
        unique_keys(natural(spark, ["a", "b"]), "k", "v", lambda k: F.lit("x"))
    assert unique_keys(natural(spark, ["a"]).limit(0), "k", "v", lambda k: F.lit("x")).collect() == []


def test_unique_keys_more_keys_than_values(spark, monkeypatch):
    """200 keys and 62 values of one character: those are all dealt first, the rest gets longer ones."""
    from quayside.operators import unique_keys as module
    monkeypatch.setattr(module, "CROWD", 10)
    names = [f"n{i}" for i in range(200)]
    first = {n: v for n, v in natural(spark, names).select("k", keys.encoded(F.col("k"), 1)).collect()}

    def table(order):
        return drawn(unique_keys(natural(spark, order), "k", "v", lambda k: keys.encoded(k, 1),
                                 longer=lambda k, n: keys.encoded(k, 1 + n)))
    got = table(names)
    assert sorted(got) == sorted(names) and len(set(got.values())) == 200
    assert sum(got[n] == first[n] for n in names) == len(set(first.values()))
    assert table(names[::-1]) == got


def test_defaults_are_those_of_an_insert(spark):
    at = dt.datetime(2024, 2, 1)
    rows = spark.createDataFrame([("B1", dt.date(2024, 1, 1), 5, 1.5), ("B2", None, None, None)],
                                 "asin string, date date, estimated_units_sold int, last_known_price double")
    got = defaults.with_defaults(rows, "sales_estimate_data", at)
    assert got.columns == SALES_TABLE.fieldNames()
    one, two = got.orderBy("asin").collect()
    assert (one.marketplace, one.is_parent, one.rank, one.created_at, str(one.last_known_price)) == ("us", False, None, at, "1.50")
    assert two.date is None  # a NULL that is there stays
    target = publish.Target(scratch(spark), "dev_")
    publish.publish_one(got, target, "sales", "1")
    assert publish.read_live(spark, target, "sales", SALES_TABLE).count() == 2
    status = defaults.with_defaults(spark.createDataFrame([("B1", None)], "asin string, has_product_data boolean"),
                                    "sync_status", at).first()
    assert status.has_product_data is None and status.has_sales_data is False and status.updated_at == at
    usage = defaults.with_defaults(spark.createDataFrame([("e",)], "endpoint string"), "api_usage", at).first()
    assert usage.call_count == 0
    with pytest.raises(ValueError, match="no column colour"):
        defaults.with_defaults(rows.withColumn("colour", F.lit(1)), "sales_estimate_data", at)


def test_counts_come_from_the_write(spark):
    """One execution of the merge: a source that counts how often it is read."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch
    target = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    source = spark.createDataFrame([(2, 3), (3, 4), (4, 5)], "k int, v int").mapInArrow(count, "k int, v int")
    merged = ups.upsert(target, source, ["k"], update_cols=["v"], on_duplicate="unique")
    rows, seen = ups.observed_counts(merged)
    place = publish.Target(scratch(spark), "dev_")
    publish.publish_one(rows, place, "t", "1")
    assert seen.get == {"inserted": 2, "updated": 1} and read.value == 3
    assert sorted(map(tuple, publish.read_live(spark, place, "t").collect())) == [(1, 1), (2, 3), (3, 4), (4, 5)]
