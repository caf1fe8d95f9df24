"""What the runs do with failures: status by target, errors, batches and the stop rule, documents seen once."""

import datetime as dt
import json

from pyspark.sql import functions as F

from quayside.operators.status import NOT_FOUND_ERROR
from quayside.plans import runs
from quayside.plans.runs import NO_SALES_DOCUMENT, NO_SALES_POINT, PRODUCT_TABLE, SALES, STATUS, USAGE, full_run, incremental_run
from quayside.schemas import SALES_TABLE, STATUS_TABLE, USAGE_TABLE
from quayside.sinks import call_log, drift, publish, run_log
from quayside.sources import ledger
from tests.test_runs import AS_OF, _sales_doc, _targets

DOC = "file string, line int, doc string"
CALL = "event_id long, ts timestamp_ntz, endpoint string, status int, n_items int"


def product_doc(*asins, **attributes):
    return json.dumps({"data": [{"id": f"us/{a}", "type": "product", "attributes": {"title": f"T {a}", **attributes}}
                                for a in asins]})


def docs(spark, file, texts):
    return spark.createDataFrame([(file, k, t) for k, t in enumerate(texts)], DOC)


def catalog(spark, asins):
    return spark.createDataFrame([(a, True) for a in asins], "asin string, product_visibility boolean")


def calls(spark, ids=()):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 31), "sales_estimates_query", 200, 1) for i in ids], CALL)


def status_of(spark, target):
    return {r.asin: r for r in publish.read_live(spark, target, STATUS, STATUS_TABLE).collect()}


def failures(spark, rows):
    return spark.createDataFrame(rows, runs.FETCH_ERRORS)


def break_table(monkeypatch, prefix, name):
    """Every write of one table of one target fails."""
    real = publish.write_version

    def write(df, target, table, *args, **kwargs):
        if (target.prefix, table) == (prefix, name):
            raise OSError(f"{prefix}{name} is read-only")
        return real(df, target, table, *args, **kwargs)
    monkeypatch.setattr(publish, "write_version", write)


def test_incremental_outcomes(spark):
    """A key not found, a failed sales request, no sales document, an item without points, an empty response."""
    t = _targets(spark)
    keys = ["B1", "B2", "B3", "B4", "B5", "B6"]
    products = docs(spark, "p1", [product_doc("B1", "B3", "B4", "B5", "B6")])
    sales = docs(spark, "s1", [_sales_doc("B1", [("2024-01-30", 5)]), _sales_doc("B4", []), json.dumps({"data": []})])
    sales = sales.withColumn("asin", F.element_at(F.array(*map(F.lit, ["B1", "B4", "B6"])), F.col("line") + 1))
    s = incremental_run(spark, catalog(spark, keys), products, sales, calls(spark), t, AS_OF, "r1",
                        fetch_errors=failures(spark, [("sales", "B3", "timeout"), ("sales", "B9", "other run")])).first()
    got = status_of(spark, t.staging)
    assert got["B1"].has_sales_data and got["B1"].error is None
    assert got["B2"].error == NOT_FOUND_ERROR and got["B2"].product_fetch_attempted_at == AS_OF
    assert got["B3"].error == "timeout" and got["B3"].has_product_data
    assert got["B5"].error == NO_SALES_DOCUMENT
    for untouched in ("B4", "B6"):
        assert got[untouched].error is None and not got[untouched].has_sales_data
    assert (s.processed, s.product_ok, s.failed, s.sales_ok, s.sales_failed) == (6, 5, 1, 1, 4)
    # One for the keys not found, two sales requests, one response without items.
    assert (s.db_errors, s.api_errors, s.parse_errors, s.run_class, s.stopped) == (0, 4, 0, "yellow", False)
    assert (s.products_inserted, s.products_updated, s.sales_inserted, s.sales_updated) == (5, 0, 1, 0)
    assert s.sample_text.startswith("1 keys not found")
    assert publish.live_paths(spark, t.production, STATUS) == []


def test_incremental_product_request_failed(spark):
    """A failed request of all keys changes no status."""
    t = _targets(spark)
    s = incremental_run(spark, catalog(spark, ["B1", "B2"]), docs(spark, "p", []), docs(spark, "s", []), calls(spark), t,
                        AS_OF, "r1", fetch_errors=failures(spark, [("product", a, "HTTP 500") for a in ("B1", "B2")])).first()
    assert (s.failed, s.api_errors, s.verdict, s.sample_text) == (2, 1, "fail", "Product request failed: HTTP 500")
    assert all(r.error is None and r.product_fetch_attempted_at is None for r in status_of(spark, t.staging).values())


def test_incremental_production_write_failed(spark, monkeypatch):
    """Staging says stored, the key's sales are not asked for, and the two product tables drift."""
    t = _targets(spark)
    break_table(monkeypatch, "prod_", PRODUCT_TABLE)
    sales = docs(spark, "s", [_sales_doc("B1", [("2024-01-30", 5)])])
    s = incremental_run(spark, catalog(spark, ["B1"]), docs(spark, "p", [product_doc("B1")]), sales, calls(spark), t,
                        AS_OF, "r1").first()
    row = status_of(spark, t.staging)["B1"]
    assert row.has_product_data and not row.has_sales_data and row.error is None
    assert (s.product_ok, s.failed, s.db_errors, s.run_class, s.verdict) == (0, 1, 1, "yellow", "fail")
    staged = publish.read_live(spark, t.staging, PRODUCT_TABLE)
    there = drift.drift_rows(staged, staged.limit(0), ["asin", "report_date"]).collect()
    assert [r.asin for r in there] == ["B1"]


def test_incremental_sales_write_stops_the_run(spark, monkeypatch):
    t = _targets(spark)
    break_table(monkeypatch, "dev_", SALES)
    s = incremental_run(spark, catalog(spark, ["B1"]), docs(spark, "p", [product_doc("B1")]),
                        docs(spark, "s", [_sales_doc("B1", [("2024-01-30", 5)])]), calls(spark), t, AS_OF, "r1").first()
    assert (s.stopped, s.run_class, s.db_errors) == (True, "red", 1)
    assert not status_of(spark, t.staging)["B1"].has_sales_data and status_of(spark, t.staging)["B1"].error is None


def test_full_run_status_by_target(spark, monkeypatch):
    """A key not found keeps its status; no point, no item and a failed request give what the reference gives."""
    t = _targets(spark)
    keys = ["B1", "B2", "B3", "B4", "B5"]
    sales = docs(spark, "s", [_sales_doc("B1", [("2024-01-30", 5)]), _sales_doc("B3", []), json.dumps({"data": []})])
    sales = sales.withColumn("asin", F.element_at(F.array(*map(F.lit, ["B1", "B3", "B5"])), F.col("line") + 1))
    s = full_run(spark, catalog(spark, keys), docs(spark, "p", [product_doc("B1", "B3", "B4", "B5")]), sales, t, AS_OF, "r1",
                 fetch_errors=failures(spark, [("sales", "B4", "timeout")])).first()
    for target in (t.staging, t.production):
        got = status_of(spark, target)
        assert got["B1"].has_sales_data and got["B1"].sales_estimate_data_synced_at == AS_OF
        assert got["B2"].error is None and got["B2"].product_fetch_attempted_at is None
        assert got["B3"].error == NO_SALES_POINT and got["B4"].error == "timeout"
        assert got["B5"].error is None and not got["B5"].has_sales_data
    assert (s.processed, s.product_ok, s.sales_todo, s.sales_ok, s.failed, s.run_class) == (5, 4, 4, 1, 4, "yellow")


def test_full_run_production_write_failed(spark, monkeypatch):
    """The two status tables disagree, and the drift query finds it."""
    t = _targets(spark)
    break_table(monkeypatch, "prod_", PRODUCT_TABLE)
    s = full_run(spark, catalog(spark, ["B1"]), docs(spark, "p", [product_doc("B1")]), docs(spark, "s", []), t, AS_OF, "r1").first()
    assert s.stopped and s.run_class == "red" and "products to production" in s.stop_reason and s.sales_todo == 0
    staged, live = (publish.read_live(spark, x, STATUS, STATUS_TABLE) for x in (t.staging, t.production))
    assert staged.first().has_product_data and not live.first().has_product_data and "read-only" in live.first().error
    found = drift.drift_rows(staged.drop("updated_at"), live.drop("updated_at"), ["asin"]).collect()
    assert [r.asin for r in found] == ["B1"]
    # The next run in mode resume reads staging's status: the product is there, its sales follow.
    monkeypatch.undo()
    s = full_run(spark, catalog(spark, ["B1"]), docs(spark, "p", []), docs(spark, "s2", [_sales_doc("B1", [("2024-01-30", 5)])]),
                 t, AS_OF, "r2", "resume").first()
    assert (s.sales_todo, s.sales_ok, s.run_class) == (1, 1, "green")


def test_full_run_stops_after_three_failing_batches_and_resumes(spark):
    """Six batches of two keys, in waves of three batches: 2, 3 and 4 store nothing."""
    t = _targets(spark)
    keys = [f"B{k:02d}" for k in range(12)]
    good = {"date_first_available": "2020-01-01"}
    landed = [product_doc("B00", "B01", **good), product_doc(*keys[2:8]), product_doc(*keys[8:], **good)]
    args = (spark, catalog(spark, keys), docs(spark, "p", landed), docs(spark, "s", []), t, AS_OF)
    more = dict(batch_size=2, wave_batches=3, product_required=["asin", "date_first_available"])
    s = full_run(*args, "r1", **more).first()
    assert s.stopped and s.run_class == "red" and "batch 4 of 6" in s.stop_reason
    # Batch 4 stops the run and is not counted; batch 5 has been announced.
    assert (s.processed, s.product_ok, s.current_batch, s.total_batches, s.sales_todo) == (6, 2, 5, 6, 0)
    assert "more errors" in s.error_text or s.n_errors <= 5
    log = {r.batch_no: (r.requested, r.returned, r.stored, r.fetch_failed)
           for r in run_log.batch_log(spark, t.staging).read("r1").collect()}
    assert log == {1: (2, 2, 2, False), 2: (2, 2, 0, False), 3: (2, 2, 0, False), 4: (2, 2, 0, False)}
    again = full_run(*args, "r1", **more).first()  # a repeated run changes nothing
    assert again.asDict() == s.asDict()
    assert publish.read_live(spark, t.staging, PRODUCT_TABLE).count() == 2
    # Resumed with documents that are whole: the keys that are left are taken.
    rest = docs(spark, "p2", [product_doc(*keys[2:], **good)])
    s = full_run(spark, catalog(spark, keys), rest, docs(spark, "s", []), t, AS_OF, "r2", "resume", **more).first()
    assert not s.stopped and (s.processed, s.product_ok, s.total_batches, s.current_batch) == (10, 10, 5, 5)


def test_full_run_failed_batch_request(spark):
    """A failed request fails its batch, names the text on its keys, and does not count towards the stop."""
    t = _targets(spark)
    keys = [f"B{k}" for k in range(6)]
    s = full_run(spark, catalog(spark, keys), docs(spark, "p", [product_doc("B0", "B1", "B4", "B5")]), docs(spark, "s", []), t,
                 AS_OF, "r1", batch_size=2, fetch_errors=failures(spark, [("product", "B2", "HTTP 503")])).first()
    for target in (t.staging, t.production):
        got = status_of(spark, target)
        assert got["B2"].error == got["B3"].error == "HTTP 503" and not got["B2"].has_product_data
        assert got["B0"].has_product_data
    assert (s.processed, s.product_ok, s.stopped) == (4, 4, False) and "Batch 2: product request failed" in s.error_text


def test_run_goes_on_behind_the_last_logged_wave(spark, monkeypatch):
    """A crash between waves: the repeated run writes only what is left."""
    t = _targets(spark)
    keys = [f"B{k}" for k in range(6)]
    args = (spark, catalog(spark, keys), docs(spark, "p", [product_doc(*keys)]), docs(spark, "s", []), t, AS_OF, "r1")
    real, seen = runs._publish_table, []

    def crash(df, name, *a, **k):
        if name == PRODUCT_TABLE:
            seen.append(name)
            if len(seen) == 2:
                raise KeyboardInterrupt
        return real(df, name, *a, **k)
    monkeypatch.setattr(runs, "_publish_table", crash)
    try:
        full_run(*args, batch_size=2, wave_batches=1)
    except KeyboardInterrupt:
        pass
    assert len(seen) == 2 and run_log.batch_log(spark, t.staging).read("r1").count() == 1
    s = full_run(*args, batch_size=2, wave_batches=1).first()
    assert len(seen) == 4 and (s.processed, s.product_ok, s.total_batches) == (6, 6, 3)
    assert publish.read_live(spark, t.production, PRODUCT_TABLE).count() == 6


def test_waves_of_new_keys_are_added_beside_the_others(spark):
    """A wave writes its own rows, not those of the waves before; keys that are there already are merged."""
    t = _targets(spark)
    keys = [f"B{k}" for k in range(6)]
    for run, title, folders in (("r1", "one", 3), ("r2", "two", 1)):
        full_run(spark, catalog(spark, keys), docs(spark, run, [product_doc(*keys, title=title)]), docs(spark, "s", []), t,
                 AS_OF, run, batch_size=2, wave_batches=1)
        for target in (t.staging, t.production):
            assert len(publish.live_folders(spark, target, PRODUCT_TABLE)) == folders
            rows = publish.read_live(spark, target, PRODUCT_TABLE).select("asin", "title").collect()
            assert sorted(map(tuple, rows)) == [(k, title) for k in keys]


def test_added_rows_are_live_once_when_an_attempt_fails_late(spark, monkeypatch):
    """An attempt on production that fails behind its commit is tried again: its folder does not stay beside the next."""
    t = _targets(spark)
    real, calls_ = publish.prune, []

    def fails_once(spark, target, name, **k):
        calls_.append(target.prefix)
        if calls_.count(t.production.prefix) == 1 and target == t.production:
            raise OSError("listing failed")
        return real(spark, target, name, **k)
    for version, asin in (("1", "a"), ("2", "b")):
        if version == "2":
            monkeypatch.setattr(publish, "prune", fails_once)
        publish.publish(spark.createDataFrame([(asin, "x")], "asin string, p string"), "t", version, t.staging, t.production,
                        partition_by="p", merge_partitions=True, pause_s=0, added=True)
    assert calls_.count(t.production.prefix) == 2
    for target in (t.staging, t.production):
        assert sorted(r.asin for r in publish.read_live(spark, target, "t").collect()) == ["a", "b"]


def test_documents_are_handled_once(spark, monkeypatch):
    """A second run over the same landing folder parses no old document and is green."""
    t = _targets(spark)
    products = docs(spark, "p1", [product_doc("B1"), "{broken", json.dumps({"data": []}), product_doc("B9")])
    sales = docs(spark, "s1", [_sales_doc("B1", [("2024-01-30", 5)])])
    first = incremental_run(spark, catalog(spark, ["B1"]), products, sales, calls(spark), t, AS_OF, "r1").first()
    assert (first.rejected_documents, first.parse_errors, first.api_errors, first.run_class) == (2, 1, 1, "yellow")
    log = run_log.handled_log(spark, t.staging)
    # The document of a key that no run has asked for stays open.
    assert [json.loads(r.doc)["data"][0]["id"] for r in ledger.unhandled(products, log, "product", "r2").collect()] == ["us/B9"]
    assert ledger.unhandled(sales, log, "sales", "r2").collect() == []
    second = incremental_run(spark, catalog(spark, ["B1"]), products, sales, calls(spark), t, AS_OF + dt.timedelta(hours=1),
                             "r2").first()
    assert (second.processed, second.rejected_documents, second.run_class) == (0, 0, "green")
    # The key shows up: its open document is taken.
    third = incremental_run(spark, catalog(spark, ["B1", "B9"]), products, sales, calls(spark), t,
                            AS_OF + dt.timedelta(hours=2), "r3").first()
    assert (third.processed, third.product_ok) == (1, 1)
    assert ledger.unhandled(products, log, "product", "r4").collect() == []


def test_usage_counts_each_call_once_for_ever(spark):
    """A run repeated after more others than pointers are kept adds nothing, nor does a call brought by several runs."""
    t = _targets(spark)
    n = publish.KEEP_POINTERS + 1
    for k in range(n):
        runs._publish_usage(spark, calls(spark, [2 * k, 2 * k + 1, 2 * k + 2]), t, "incremental", f"v{k}")
    runs._publish_usage(spark, calls(spark, [0, 1, 2]), t, "incremental", "v0")
    for target in (t.staging, t.production):
        assert publish.read_live(spark, target, USAGE, USAGE_TABLE).first().call_count == 2 * n + 1


def test_call_log_keys(spark):
    root = f"{_targets(spark).staging.root}/log"
    at = dt.datetime(2024, 1, 5, 3)
    rows = [(1, at, "e", 200, 1), (1, at + dt.timedelta(hours=1), "f", 200, 1), (1, at + dt.timedelta(days=1), "e", 200, 1),
            (None, at, "e", 200, 1), (None, at, "e", 200, 1), (None, at, "e", 200, 2), (2, at, "e", 500, 1), (3, None, "e", 200, 1)]
    for _ in range(2):
        days = call_log.append_calls(spark, spark.createDataFrame(rows, CALL), root)
    assert [d.day for d in days] == [5, 6]
    got = {(r.usage_date.day, r.endpoint): r.call_count for r in call_log.daily_counts(spark, root, days).collect()}
    # Of one id on one day the earlier row counts; calls without an id are known by their columns.
    assert got == {(5, "e"): 3, (6, "e"): 1}
    assert call_log.daily_counts(spark, root, [dt.date(2023, 1, 1)]).collect() == []
