"""Ad-hoc syncs, the keyword load and its access paths, the SQL functions."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quayside.functions import dates, ids, keys
from quayside.functions.sql import register_sql_functions
from quayside.operators import flatten as flt
from quayside.plans import adhoc, keyword_load
from quayside.plans.runs import PRODUCT_TABLE, SALES, RunTargets
from quayside.schemas import SALES_TABLE
from quayside.sinks import keyword_paths as paths
from quayside.sinks import publish
from quayside.sinks.publish import Target, read_live

AT = dt.datetime(2024, 2, 1)


@pytest.fixture
def targets(tmp_path):
    return RunTargets(Target(str(tmp_path), "dev_"), Target(str(tmp_path), "prod_"), sales_buckets=2)


def _product(*asins, **attributes):
    return json.dumps({"data": [{"id": f"us/{a}", "type": "p", "attributes": {"title": "t", **attributes}} for a in asins]})


def _sales(asin, *points):
    data = [{"date": d, "estimated_units_sold": u, "last_known_price": 2.5} for d, u in points]
    return json.dumps({"data": [{"id": f"us/{asin}", "type": "s", "attributes": {"asin": asin, "data": data}}]})


def _by_request(df):
    return {r.request_id: r for r in df.collect()}


def _counts(r):
    return (r.staging_inserted, r.staging_updated, r.production_inserted, r.production_updated)


def test_product_requests(spark, targets):
    requests = spark.createDataFrame([(1, ["A", "B"]), (2, ["B", "C"]), (3, ["D"]), (4, []), (5, ["E"] * 101), (6, ["F"]),
                                      (7, None), (8, ["G"])], "request_id long, asins array<string>")
    responses = spark.createDataFrame(
        [(1, _product("A", "B", title="one")), (2, _product("B", "C", title="two")), (3, '{"data": []}'),
         (5, _product("E")), (6, '{"data": [')], "request_id long, doc string")
    got = _by_request(adhoc.sync_products(requests, responses, targets, AT, "1"))
    assert {k: r.outcome for k, r in got.items()} == {
        1: "ok", 2: "ok", 3: "empty_response", 4: "no_keys", 5: "too_many_keys", 6: "parse_error", 7: "no_keys",
        8: "no_response"}
    assert _counts(got[1]) == (2, 0, 2, 0) and _counts(got[2]) == (1, 1, 1, 1) and _counts(got[6]) == (0, 0, 0, 0)
    assert (got[2].asins_requested, got[2].products_found) == (2, 2)
    for t in (targets.staging, targets.production):
        rows = {r.asin: r.title for r in read_live(spark, t, PRODUCT_TABLE).collect()}
        assert rows == {"A": "one", "B": "two", "C": "two"}
    again = _by_request(adhoc.sync_products(requests, responses, targets, AT, "2"))
    assert _counts(again[1]) == (0, 2, 0, 2)


def test_product_request_production_fails(spark, targets, monkeypatch):
    real = publish.publish_one

    def broken(df, target, *args, **kw):
        if target.prefix == "prod_":
            raise OSError("production is away")
        return real(df, target, *args, **kw)
    monkeypatch.setattr(publish, "publish_one", broken)
    monkeypatch.setattr(publish.time, "sleep", lambda s: None)
    requests = spark.createDataFrame([(1, ["A"]), (2, ["B"])], "request_id long, asins array<string>")
    responses = spark.createDataFrame([(1, _product("A"))], "request_id long, doc string")
    got = _by_request(adhoc.sync_products(requests, responses, targets, AT, "1"))
    assert got[1].outcome == "production_failed" and _counts(got[1]) == (1, 0, 0, 0)
    assert got[2].outcome == "no_response"


def test_sales_requests(spark, targets):
    schema = "request_id long, asin string, marketplace string, start_date string, end_date string"
    requests = spark.createDataFrame(
        [(1, "A", "us", "2022-01-01", "2024-01-31"), (2, "A", "us", "2024-01-01", "2024-01-31"),
         (3, "B", "de", "2024-01-01", "2024-01-31"), (4, "", "us", "2024-01-01", "2024-01-31"),
         (5, "C", "us", "2024-1-1", "2024-01-31"), (6, "D", "us", "2024-01-01", "2024-01-31")], schema)
    responses = spark.createDataFrame(
        [(1, _sales("A", ("2024-01-01", 1), ("2024-01-02", 2))), (2, _sales("A", ("2024-01-02", 9))),
         (3, _sales("B", ("2024-01-05", 3))), (6, _sales("D", ("2024-01-05", 3), ("soon", 4)))],
        "request_id long, doc string")
    got = _by_request(adhoc.sync_sales(requests, responses, targets, AT, "1"))
    assert {k: r.outcome for k, r in got.items()} == {1: "ok", 2: "ok", 3: "ok", 4: "missing_required", 5: "bad_start_date",
                                                      6: "bad_point"}
    assert (got[1].date_range_adjusted, str(got[1].start_date)) == (True, "2023-01-31")
    assert _counts(got[1]) == (2, 0, 2, 0) and _counts(got[2]) == (0, 1, 0, 1) and _counts(got[6]) == (0, 0, 0, 0)
    rows = {(r.asin, r.marketplace, str(r.date)): r.estimated_units_sold
            for r in read_live(spark, targets.production, SALES, SALES_TABLE).collect()}
    assert rows == {("A", "us", "2024-01-01"): 1, ("A", "us", "2024-01-02"): 9, ("B", "de", "2024-01-05"): 3}


def _keyword(i, name="n", **attributes):
    return {"id": i, "type": "keyword", "attributes": {"name": name, "country": "us", **attributes}}


def test_keyword_load(spark, tmp_path):
    target = Target(str(tmp_path), "dev_")
    docs = spark.createDataFrame(
        [(1, json.dumps({"data": [_keyword("a", "first"), _keyword("b")]})), (2, '{"data": []}'), (3, "{"),
         (4, json.dumps({"data": [_keyword("a", "second"), _keyword(None)]}))], "line long, doc string")
    s = keyword_load.load_keywords(docs, target, "r:1").first()
    assert tuple(s)[1:] == (4, 1, 1, 4, 1, 2, 1)
    more = spark.createDataFrame([(1, json.dumps({"data": [_keyword("b", "late"), _keyword("c")]}))], "line long, doc string")
    assert keyword_load.load_keywords(more, target, "2").first().inserted == 1
    again = keyword_load.load_keywords(docs, target, "r:1").first()  # the same load once more
    assert (again.inserted, again.ignored) == (2, 1)
    table = read_live(spark, target, keyword_load.KEYWORDS, keyword_load.TABLE)
    assert {(r.id, r["name"]) for r in table.collect()} == {("a", "first"), ("b", "n"), ("c", "n")}
    assert keyword_load.load_keywords(docs.limit(0), target, "3").first().documents == 0
    assert table.count() == 3


def test_access_paths(spark, tmp_path):
    values = [None, -5.0, 0.0, 0.5, 1.0, 2.0, 3.0, 4.0, 1e20, 7.0]
    rows = [(f"k{i:02d}", "us" if i % 2 else "de", f"A{i}", f"n{i % 3}", v) for i, v in enumerate(values)]
    kw = spark.createDataFrame(rows, "id string, country string, primary_asin string, name string, v double").select(
        "id", "country", "primary_asin", "name", F.lit("c").alias("dominant_category"),
        F.col("v").cast("decimal(38,10)").alias("monthly_search_volume_exact"),
        F.col("v").cast("decimal(38,10)").alias("ease_of_ranking_score"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").substr(2, 2).cast("int") * 20).cast("timestamp_ntz").alias("updated_at"))
    root = str(tmp_path / "paths")
    paths.write_paths(kw, root, filter_values=100)
    zones = kw.select("monthly_search_volume_exact", paths.zone_of("monthly_search_volume_exact", "decimal").alias("z")).collect()
    ordered = sorted(zones, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.z for r in ordered] == sorted(r.z for r in zones)
    for by in paths.ORDERS:
        for k in (1, 3, 8, 10, 50):
            want = kw.orderBy(F.col(by).desc_nulls_last(), "id").limit(k).select("id").collect()
            assert paths.top(spark, root, kw.schema, by, k).select("id").collect() == want
    assert "zone" not in kw.schema.fieldNames()
    high = paths.top(spark, root, kw.schema, "monthly_search_volume_exact", 2)
    assert "PartitionFilters: [isnotnull(zone" in high._jdf.queryExecution().toString()
    assert [r.id for r in paths.lookup(spark, root, kw.schema, primary_asin="A3").collect()] == ["k03"]
    found = paths.lookup(spark, root, kw.schema, country="de", name="n1")
    assert {r.id for r in found.collect()} == {"k04"}
    plan = found._jdf.queryExecution().toString()
    assert "EqualTo(name,n1)" in plan and "PartitionFilters: [isnotnull(country" in plan
    with pytest.raises(ValueError):
        paths.lookup(spark, root, kw.schema, colour="red")
    empty = str(tmp_path / "empty")
    paths.write_paths(kw.limit(0), empty)
    assert paths.top(spark, empty, kw.schema, "updated_at", 5).count() == 0


def test_bloom_filters_are_written(spark, tmp_path):
    """A key that no file holds, between the least and greatest of each, is told by the filter: no row group is read."""
    kw = spark.range(20000).select(
        F.concat(F.lit("k"), "id").alias("id"), F.lit("us").alias("country"), F.md5(F.col("id").cast("string")).alias("primary_asin"),
        F.lit("n").alias("name"), F.lit("c").alias("dominant_category"),
        F.col("id").cast("decimal(38,10)").alias("monthly_search_volume_exact"),
        F.col("id").cast("decimal(38,10)").alias("ease_of_ranking_score"), F.lit(AT).cast("timestamp_ntz").alias("updated_at"))
    root = str(tmp_path / "paths")
    paths.write_paths(kw, root, filter_values=20000)
    found = paths.lookup(spark, root, kw.schema, primary_asin="7" * 32)
    assert found.collect() == []
    assert found._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value() == 0


def test_sql_functions_equal_the_expressions(spark):
    register_sql_functions(spark)
    assert len(register_sql_functions(spark)) == 6  # a second time does no harm
    df = spark.createDataFrame([("us/B1", "2024-02-29"), ("B1", "2023-03-31"), ("us/B1/x", "2024-1-1"), ("", "x"), (None, None)],
                               "id string, d string")
    day = dates.lenient_date(F.col("d"))
    got = df.selectExpr(
        "qs_asin_from_id(id)", "qs_id_marketplace(id)", "qs_id_asin(id)", "qs_lenient_date(d)",
        "qs_shift_date(qs_lenient_date(d), -1, 1, -1)", "qs_surrogate_key(id, 'p', 8)", "qs_surrogate_key(id, 'pp', 0)",
        "qs_surrogate_key(id, 'x', 45)")
    want = df.select(ids.asin_from_id(F.col("id")), ids.id_marketplace(F.col("id")), ids.id_asin(F.col("id")), day,
                     dates.shift_date(day, -1, 1, -1), keys.surrogate_key(F.col("id"), "p", 8),
                     keys.surrogate_key(F.col("id"), "pp", 0), keys.surrogate_key(F.col("id"), "x", 45))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert "PythonUDF" not in got._jdf.queryExecution().toString()


def test_joins_that_grow_with_the_requests_are_shuffled(spark):
    """The documents' text or the keys of a target, broadcast, would go through the driver's memory whole."""
    requests = spark.createDataFrame([(1, None)], "request_id long, rejected string")
    responses = spark.createDataFrame([(1, "{}")], "request_id long, doc string")
    seen = []
    adhoc._parsed(requests, responses, lambda docs: seen.append(docs) or docs)
    rows = spark.createDataFrame([(1, "B1", 1), (2, "B1", 2), (2, "B2", 3)], f"request_id long, asin string, {flt.SEQ} long")
    counts = adhoc._write_counts(rows, rows.where("asin = 'B2'"), ["asin"], "staging")
    assert {tuple(r) for r in counts.collect()} == {(1, 1, 0), (2, 0, 2)}
    for df in (*seen, counts):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
