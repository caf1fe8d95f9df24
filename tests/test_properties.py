"""Property tests: random inputs, invariants and a sequential model."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st_

from quayside.operators import select as sel
from quayside.operators import status as st
from quayside.operators import upsert as ups
from quayside.schemas import STATUS_TABLE

AS_OF = dt.datetime(2024, 2, 1)
T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=int(__import__("os").environ.get("QUAYSIDE_EXAMPLES", "15")), deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st_.sampled_from(["a", "b", "c", "d", "e"])


@SETTINGS
@given(target=st_.lists(st_.tuples(keys, st_.integers(0, 9)), max_size=6, unique_by=lambda r: r[0]),
       source=st_.lists(st_.tuples(keys, st_.integers(0, 9), st_.integers(0, 99)), max_size=8))
def test_upsert_counts_and_keys(spark, target, source):
    t = spark.createDataFrame(target, "k string, v int")
    s = spark.createDataFrame(source, "k string, v int, seq int")
    out = ups.upsert(t, s, ["k"], update_cols=["v"], seq="seq")
    rows = out.collect()
    c = ups.upsert_counts(out).first()
    assert c.inserted + c.updated == len({k for k, _, _ in source})
    assert sorted(r.k for r in rows) == sorted({k for k, _ in target} | {k for k, _, _ in source})
    for r in rows:
        mine = [x for x in source if x[0] == r.k]
        if mine:
            top = max(x[2] for x in mine)
            winners = {x[1] for x in mine if x[2] == top}
            assert r.v in winners  # last write wins (any of the rows tied on seq)
        else:
            assert r.v == dict(target)[r.k]


@SETTINGS
@given(status_keys=st_.sets(keys, max_size=5), visible=st_.lists(st_.tuples(st_.one_of(keys, st_.none(), st_.just("")),
                                                                          st_.booleans()), max_size=8))
def test_cleanup_partitions_status(spark, status_keys, visible):
    rows = [(k, True, True, None, None, None, None, T0, None) for k in sorted(status_keys)]
    status = spark.createDataFrame(rows, STATUS_TABLE)
    cat = spark.createDataFrame(visible, "asin string, product_visibility boolean")
    vis = sel.visible_asins(cat)
    kept, deleted = sel.cleanup_kept(status, vis).count(), sel.cleanup_deleted(status, vis).count()
    assert kept + deleted == len(status_keys)
    want = {k for k, v in visible if v and k}
    assert kept == len(status_keys & want)


@SETTINGS
@given(n_new=st_.integers(0, 30), n_stale=st_.integers(0, 30), limit=st_.integers(1, 40))
def test_priority_limit_and_order(spark, n_new, n_stale, limit):
    rows = [(f"N{i:02d}", False, False, None, None, None, None, T0, None) for i in range(n_new)]
    rows += [(f"S{i:02d}", True, False, None, T0 - dt.timedelta(days=40 + i), None, None, T0, None)
             for i in range(n_stale)]
    got = sel.select_priority(spark.createDataFrame(rows, STATUS_TABLE), AS_OF, limit).collect()
    assert len(got) == min(limit, n_new + n_stale)
    assert sum(r.is_new for r in got) == min(limit, n_new)


# --- status fold against a sequential model -------------------------------

KINDS = list(st.EVENT_RULES)


def model(initial: dict, events: list) -> dict:
    """Apply events one by one, like single-row statements."""
    table = {k: dict(v) for k, v in initial.items()}
    for asin, seq, kind, at, text, pf, sf in sorted(events, key=lambda e: e[1]):
        row = table.get(asin)
        if kind == "key_removed":
            table.pop(asin, None)
            continue
        if kind in st.INSERT_KINDS and row is None:
            row = table[asin] = {"has_product_data": False, "has_sales_data": False, "error": None,
                                 "product_data_synced_at": None, "sales_estimate_data_synced_at": None,
                                 "product_fetch_attempted_at": None, "created_at": at, "updated_at": at}
            if kind == "key_added":
                continue
        elif row is None or kind == "key_added":
            continue
        for col, spec in st.EVENT_RULES[kind].items():
            row[col] = {"at": at, "text": text, "not_found": st.NOT_FOUND_ERROR,
                        "product_flag": pf, "sales_flag": sf}.get(spec, spec) if isinstance(spec, str) else spec
        if kind not in st.NO_STAMP_KINDS:
            row["updated_at"] = at
    return table


event = st_.tuples(st_.sampled_from(["a", "b", "c"]), st_.sampled_from(KINDS), st_.booleans(), st_.booleans())


@SETTINGS
@given(present=st_.sets(st_.sampled_from(["a", "b", "c"])), evs=st_.lists(event, max_size=12))
def test_fold_matches_sequential_model(spark, present, evs):
    initial = {k: {"has_product_data": True, "has_sales_data": None, "error": "old",
                   "product_data_synced_at": T0, "sales_estimate_data_synced_at": None,
                   "product_fetch_attempted_at": None, "created_at": T0, "updated_at": None} for k in present}
    events = [(a, i, kind, T0 + dt.timedelta(hours=i + 1), f"e{i}", pf, sf)
              for i, (a, kind, pf, sf) in enumerate(evs)]
    status = spark.createDataFrame([(k, *[v[c] for c in STATUS_TABLE.fieldNames()[1:]]) for k, v in initial.items()],
                                   STATUS_TABLE)
    ev = spark.createDataFrame(events, "asin string, seq long, kind string, at timestamp_ntz, error_text string, "
                                       "product_flag boolean, sales_flag boolean")
    got = {r.asin: {c: r[c] for c in STATUS_TABLE.fieldNames()[1:]} for r in st.fold_status(status, ev).collect()}
    assert got == model(initial, events)


# --- calendar shift against field-wise addition with forward overflow ------

def field_add(d: dt.date, years: int, months: int, days: int) -> dt.date:
    """Add to the fields, then let day overflow roll forward (a model of the
    reference's date arithmetic)."""
    total = d.year * 12 + (d.month - 1) + 12 * years + months
    y, m = divmod(total, 12)
    return dt.date(y, m + 1, 1) + dt.timedelta(days=d.day - 1 + days)


@SETTINGS
@given(days=st_.lists(st_.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31)), min_size=1,
                      max_size=20),
       years=st_.integers(-2, 2), months=st_.integers(-13, 13), extra=st_.integers(-40, 40))
def test_shift_date_matches_field_addition(spark, days, years, months, extra):
    import duckdb
    from pyspark.sql import functions as F

    from quayside.functions.dates import shift_date, shift_date_sql
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.s for r in df.select(shift_date(F.col("d"), years, months, extra).alias("s")).collect()]
    want = [field_add(d, years, months, extra) for d in days]
    assert got == want
    duck = [duckdb.sql(f"SELECT {shift_date_sql(f'DATE {chr(39)}{d}{chr(39)}', years, months, extra)}").fetchall()[0][0]
            for d in days[:3]]
    assert duck == want[:3]


@SETTINGS
@given(keys=st_.sets(st_.text(alphabet="abcdefXYZ0123", min_size=1, max_size=6), min_size=1, max_size=300),
       parts=st_.integers(1, 6), size=st_.integers(1, 50))
def test_plan_batches_matches_enumeration(spark, keys, parts, size):
    from quayside.operators import batches
    df = spark.createDataFrame([(k,) for k in keys], "asin string")
    got = {r.asin: (r.position, r.batch_no, r.batch_count)
           for r in batches.plan_batches(df, batch_size=size, num_partitions=parts).collect()}
    n = len(keys)
    want = {k: (i + 1, i // size + 1, -(-n // size)) for i, k in enumerate(sorted(keys))}
    assert got == want


@SETTINGS
@given(calls=st_.lists(st_.tuples(st_.integers(0, 3), st_.sampled_from(["p", "s"]), st_.booleans()), max_size=30),
       cut=st_.integers(0, 30))
def test_counter_merge_is_split_invariant(spark, calls, cut):
    from pyspark.sql import functions as F

    from quayside.operators import usage
    rows = [(i, T0 + dt.timedelta(days=d, minutes=i), ep, 200, 1) for i, (d, ep, _) in enumerate(calls)]
    schema = "event_id long, ts timestamp_ntz, endpoint string, status int, n_items int"
    df = spark.createDataFrame(rows, schema)
    whole = usage.usage_daily(df)
    first = usage.usage_daily(df.filter(F.col("event_id") < cut))
    rest = usage.usage_daily(df.filter(F.col("event_id") >= cut))
    merged = usage.merge_counters(first, rest)
    key = ["usage_date", "endpoint"]
    got = sorted((r.usage_date, r.endpoint, r.call_count) for r in merged.collect())
    want = sorted((r.usage_date, r.endpoint, r.call_count) for r in whole.collect())
    assert got == want
    # created_at stays the earliest call, updated_at the latest.
    w = {tuple(r[k] for k in key): (r.created_at, r.updated_at) for r in whole.collect()}
    for r in merged.collect():
        assert (r.created_at, r.updated_at) == w[(r.usage_date, r.endpoint)]


@SETTINGS
@given(rows=st_.lists(st_.tuples(keys, st_.integers(0, 50), st_.integers(0, 9)), max_size=25,
                      unique_by=lambda r: (r[0], r[1])))
def test_dedupe_last_matches_python(spark, rows):
    from quayside.operators import batches
    df = spark.createDataFrame(rows, "k string, seq int, v int")
    got = {r.k: (r.seq, r.v) for r in batches.dedupe_last(df, ["k"], "seq").collect()}
    want = {}
    for k, seq, v in sorted(rows, key=lambda r: r[1]):
        want[k] = (seq, v)
    assert got == want
