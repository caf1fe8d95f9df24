"""Sync-status control table: all per-key changes as one fold (STA-1..12).

The reference issues one ``UPDATE ... WHERE asin`` per event. Here the
events ``(asin, seq, kind, at, error_text[, product_flag, sales_flag])`` are
folded in one pass: for every status column, the last event that *sets* it
wins (``max_by`` over ``seq``, wrapped in a struct so "set to NULL" differs
from "not set"). ``max_by`` is a partial aggregate, so a key with millions of
events is pre-aggregated on the map side.

Row existence follows the events too: ``key_removed`` deletes the row,
``key_added`` inserts it only when absent, ``fresh_reset`` inserts or
resets. Updates to a key that is absent at that moment are no-ops, like an
``UPDATE`` that matches nothing. Status columns of a (re)inserted row start
from the table defaults (both flags false, stamps NULL, created now).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import ts_lit
from quayside.schemas import STATUS_TABLE

NOT_FOUND_ERROR = "Product not found in product API"

FLAG_COLS = ("has_product_data", "has_sales_data")
STATUS_COLS = ("has_product_data", "has_sales_data", "error", "product_data_synced_at",
               "sales_estimate_data_synced_at", "product_fetch_attempted_at")

# Event kind -> {column: value}. Values: True/False, None (set NULL), "at"
# (event time), "text" (event error text), "not_found" (fixed text),
# "product_flag"/"sales_flag" (flags carried by the event).
EVENT_RULES: dict[str, dict[str, object]] = {
    "fresh_reset": {"has_product_data": False, "has_sales_data": False, "error": None,
                    "product_data_synced_at": None, "sales_estimate_data_synced_at": None},
    "resume": {},
    "key_added": {},
    "product_stored": {"has_product_data": True, "error": None, "product_data_synced_at": "at"},
    "product_store_failed": {"has_product_data": False, "error": "text", "product_data_synced_at": None},
    "product_not_found": {"error": "not_found", "product_fetch_attempted_at": "at"},
    "batch_fetch_failed": {"error": "text"},
    "sales_stored": {"has_sales_data": True, "error": None, "sales_estimate_data_synced_at": "at"},
    "sales_fetch_failed": {"has_product_data": True, "has_sales_data": False, "error": "text"},
    "sales_all_failed": {"error": "text"},
    "status_set_clear": {"has_product_data": "product_flag", "has_sales_data": "sales_flag", "error": None},
    "key_removed": {},
}
INSERT_KINDS = ("fresh_reset", "key_added")
NO_STAMP_KINDS = ("resume", "key_added", "key_removed")


def _value(spec: object, dtype) -> Column:
    if spec == "at":
        v = F.col("at")
    elif spec == "text":
        v = F.col("error_text")
    elif spec == "not_found":
        v = F.lit(NOT_FOUND_ERROR)
    elif spec in ("product_flag", "sales_flag"):
        v = F.col(spec)
    else:
        v = F.lit(spec)
    return v.cast(dtype)


def _sets(col: str) -> tuple[list[str], Column]:
    kinds = [k for k, rule in EVENT_RULES.items() if col in rule]
    value = None
    for k in kinds:
        v = _value(EVENT_RULES[k][col], STATUS_TABLE[col].dataType)
        value = F.when(F.col("kind") == k, v) if value is None else value.when(F.col("kind") == k, v)
    return kinds, value


# Event keys up to this many are broadcast (size checked) to split the status
# table into touched and untouched rows, so the untouched rows are not
# shuffled; above it, the fold joins the whole table.
MAX_BROADCAST_KEYS = 100_000


def fold_status(status: DataFrame, events: DataFrame, max_broadcast_keys: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """Apply ``events`` to ``status`` in ``seq`` order; returns the new table.

    An incremental run's events touch few keys. When the distinct event
    keys are at most ``max_broadcast_keys`` (checked), they are broadcast and
    only those status rows meet the folded events; every other row passes
    through unchanged, so the status table is scanned but never shuffled."""
    for c in ("product_flag", "sales_flag"):
        if c not in events.columns:
            events = events.withColumn(c, F.lit(None).cast("boolean"))
    unknown = set(EVENT_RULES)
    events = events.filter(F.col("kind").isin(*unknown))

    # One aggregation over all events: the last delete, and per column the
    # last event that sets it (validity against deletes is decided below).
    aggs = [F.max(F.when(F.col("kind") == "key_removed", F.col("seq"))).alias("_del")]
    for c in STATUS_COLS:
        kinds, value = _sets(c)
        sets = F.col("kind").isin(*kinds)
        aggs.append(F.max_by(F.struct(F.col("seq").alias("seq"), value.alias("v")),
                             F.when(sets, F.col("seq"))).alias(f"_{c}"))
    stamp = ~F.col("kind").isin(*NO_STAMP_KINDS)
    aggs.append(F.max_by(F.struct(F.col("seq").alias("seq"), F.col("at").alias("v")),
                         F.when(stamp, F.col("seq"))).alias("_updated_at"))
    main = events.groupBy("asin").agg(*aggs)

    # The (re)creating insert: the first insert event after the last delete.
    # Only insert events (rare: key additions, resets) meet the delete marker.
    inserts = events.filter(F.col("kind").isin(*INSERT_KINDS)).select("asin", "seq", "at")
    ins = (inserts.join(main.select("asin", "_del"), "asin")
           .filter(F.col("_del").isNull() | (F.col("seq") > F.col("_del")))
           .groupBy("asin").agg(F.min(F.struct("seq", "at")).alias("_ins")))
    folded = main.join(ins, "asin", "left")

    untouched = None
    ev_keys = events.select("asin").distinct()
    if ev_keys.limit(max_broadcast_keys + 1).count() <= max_broadcast_keys:
        # Size checked above: at most ``max_broadcast_keys`` keys are broadcast.
        keys = F.broadcast(ev_keys)
        untouched = status.join(keys, "asin", "left_anti")
        status = status.join(keys, "asin", "left_semi")

    s = status.withColumn("_present", F.lit(True))
    j = s.join(folded, "asin", "full_outer")
    present = F.coalesce(F.col("_present"), F.lit(False))
    deleted = F.col("_del").isNotNull()
    recreated = (deleted | ~present) & F.col("_ins").isNotNull()
    exists = F.when(deleted | ~present, F.col("_ins").isNotNull()).otherwise(present)
    start = F.when(recreated, F.col("_ins.seq"))  # NULL = the stored row is the base

    def pick(c: str, base: Column) -> Column:
        setter = F.col(f"_{c}")
        valid = setter.isNotNull() & (start.isNull() | (setter.getField("seq") >= start))
        return F.when(valid, setter.getField("v")).otherwise(base)

    out = []
    for c in STATUS_TABLE.fieldNames():
        dtype = STATUS_TABLE[c].dataType
        if c == "asin":
            e = F.col("asin")
        elif c in STATUS_COLS:
            default = F.lit(False) if c in FLAG_COLS else F.lit(None)
            base = F.when(recreated, default.cast(dtype)).otherwise(F.col(c).cast(dtype) if c in status.columns
                                                                    else F.lit(None).cast(dtype))
            e = pick(c, base)
        elif c == "created_at":
            e = F.when(recreated, F.col("_ins.at")).otherwise(
                F.col(c) if c in status.columns else F.lit(None).cast(dtype))
        else:  # updated_at
            base = F.when(recreated, F.col("_ins.at")).otherwise(
                F.col(c) if c in status.columns else F.lit(None).cast(dtype))
            e = pick("updated_at", base)
        out.append(e.cast(dtype).alias(c))
    result = j.filter(exists).select(*out)
    if untouched is not None:
        same = [(F.col(c) if c in untouched.columns else F.lit(None)).cast(STATUS_TABLE[c].dataType).alias(c)
                for c in STATUS_TABLE.fieldNames()]
        result = result.unionByName(untouched.select(*same))
    return result


STATUS_BUCKETS = 1024        # bucket count when none is given and the table size is unknown
ROWS_PER_BUCKET = 1_000_000  # about 50-100 MB of status rows per bucket folder
MAX_BUCKETS = 4096


def choose_buckets(n_rows: int) -> int:
    """Smallest power of two with at most ``ROWS_PER_BUCKET`` keys per
    bucket (1 for small tables, up to ``MAX_BUCKETS``)."""
    b = 1
    while b < MAX_BUCKETS and b * ROWS_PER_BUCKET < n_rows:
        b *= 2
    return b


def bucket_column(buckets: int = STATUS_BUCKETS) -> str:
    """Name of the status table's partition column; it carries the bucket
    count, so a table written with another count is never merged with it."""
    return f"bucket_{buckets}"


def status_bucket(asin: Column, buckets: int = STATUS_BUCKETS) -> Column:
    """Stable hash bucket of a key (the status table's partition value)."""
    return F.pmod(F.xxhash64(asin), F.lit(buckets)).cast("int")


def fresh_reset_events(keys: DataFrame, as_of: dt.datetime, seq: int = 0) -> DataFrame:
    """STA-1: one ``fresh_reset`` event per key (full run, mode fresh)."""
    return keys.select("asin", F.lit(seq).cast("bigint").alias("seq"), F.lit("fresh_reset").alias("kind"),
                       ts_lit(as_of).alias("at"), F.lit(None).cast("string").alias("error_text"))


def stuck_stale(status: DataFrame, as_of: dt.datetime, stale_days: int = 30) -> DataFrame:
    """Keys that had product data, were later not found, and are therefore
    picked as stale again every run (the reference keeps the flag and the
    old sync time when a stale key is not found)."""
    cut = ts_lit(as_of - dt.timedelta(days=stale_days))
    return (status.filter((F.col("has_product_data") == F.lit(True)) & (F.col("error") == NOT_FOUND_ERROR)
                          & (F.col("product_data_synced_at") < cut))
            .select("asin", "product_data_synced_at", "product_fetch_attempted_at"))
