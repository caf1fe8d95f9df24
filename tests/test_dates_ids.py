import datetime as dt

from pyspark.sql import functions as F

from quayside.functions.dates import lenient_date, lenient_timestamp, shift_date
from quayside.functions.ids import asin_from_id, id_asin, id_marketplace
from quayside.plans import windows


def test_calendar_shift_normalises_forward(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2024, 3, 31),)], "d date")
    got = df.select(shift_date(F.col("d"), years=-1).alias("y"),
                    shift_date(F.col("d"), months=-1, days=-1).alias("m")).collect()
    assert got[0].y == dt.date(2023, 3, 1)
    assert got[1].m == dt.date(2024, 3, 1)


def test_lenient_parsers(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-1-2",), ("",), (None,), ("2024-01-02T03:04:05Z",),
                                ("2024-01-02T03:04:05.25+02:00",)], "s string")
    got = df.select(lenient_date(F.col("s")).alias("d"), lenient_timestamp(F.col("s")).alias("t")).collect()
    assert [r.d for r in got] == [dt.date(2024, 1, 2), None, None, None, None, None]
    assert got[4].t == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[5].t == dt.datetime(2024, 1, 2, 1, 4, 5, 250000)


def test_id_rules(spark):
    df = spark.createDataFrame([("B0",), ("us/B1",), ("us/B2/x",)], "id string")
    got = df.select(asin_from_id(F.col("id")).alias("a"), id_marketplace(F.col("id")).alias("m"),
                    id_asin(F.col("id")).alias("s")).collect()
    assert [r.a for r in got] == ["B0", "B1", "us/B2/x"]
    assert [r.m for r in got] == ["B0", "us", "us"]
    assert [r.s for r in got] == ["", "B1", "B2"]


def test_windows_and_clamp(spark):
    sel = spark.createDataFrame([("A", None), ("B", dt.datetime(2024, 1, 10, 5)), ("C", dt.datetime(2024, 3, 1))],
                                "asin string, sales_estimate_data_synced_at timestamp_ntz")
    w = {r.asin: r for r in windows.plan_sales_windows(sel, dt.datetime(2024, 3, 1)).collect()}
    assert (w["A"].start_date, w["A"].end_date) == (dt.date(2023, 2, 28), dt.date(2024, 2, 29))
    assert w["B"].start_date == dt.date(2024, 1, 10) and not w["B"].is_empty_window
    assert w["C"].is_empty_window
    req = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2024, 2, 29)), (dt.date(2024, 1, 1), dt.date(2024, 2, 1))],
                                "start_date date, end_date date")
    got = windows.clamp_window(req).collect()
    assert got[0].start_date == dt.date(2023, 3, 1) and got[0].date_range_adjusted
    assert got[1].start_date == dt.date(2024, 1, 1) and not got[1].date_range_adjusted


def test_argument_checks():
    import pytest
    assert windows.check_request_args(1, "resume") == "resume"
    assert windows.check_request_args(5, "force", force_resync=True) == "fresh"
    for bad in (dict(n_keys=0), dict(n_keys=101), dict(n_keys=1, sync_mode="force"),
                dict(n_keys=1, date_range="6months")):
        with pytest.raises(ValueError):
            windows.check_request_args(**bad)


def test_validate_requests_reason_order(spark):
    rows = [
        (1, 5, "us", "fresh", False, "1month", "2024-01-01", "2024-01-31"),    # valid
        (2, 5, "", "fresh", False, "1month", "2024-01-01", "2024-01-31"),      # missing marketplace
        (3, 5, "us", "fresh", False, "1month", "2024-1-1", "2024-01-31"),      # bad start
        (4, 5, "us", "fresh", False, "1month", "2024-01-01", "31/01/2024"),    # bad end
        (5, 0, "us", "fresh", False, "1month", "2024-01-01", "2024-01-31"),    # no keys
        (6, 101, "us", "fresh", False, "1month", "2024-01-01", "2024-01-31"),  # too many
        (7, 5, "us", "force", False, "1month", "2024-01-01", "2024-01-31"),    # bad mode
        (8, 5, "us", "force", True, "1month", "2024-01-01", "2024-01-31"),     # legacy flag -> fresh, valid
        (9, 5, "us", None, False, "6months", "2024-01-01", "2024-01-31"),      # default mode, bad range
    ]
    df = spark.createDataFrame(rows, "request_id int, n_keys int, marketplace string, sync_mode string, "
                                     "force_resync boolean, date_range string, start_date string, end_date string")
    got = {r.request_id: (r.reject_reason, r.sync_mode_normalised) for r in windows.validate_requests(df).collect()}
    assert got == {1: (None, "fresh"), 2: ("missing_required", "fresh"), 3: ("bad_start_date", "fresh"),
                   4: ("bad_end_date", "fresh"), 5: ("no_keys", "fresh"), 6: ("too_many_keys", "fresh"),
                   7: ("bad_sync_mode", "force"), 8: (None, "fresh"), 9: ("bad_date_range", "fresh")}
