"""Which keys to refresh: visible keys, status clean-up, new/stale selection.

All functions are lazy ``DataFrame -> DataFrame`` plans with an explicit
``as_of``. Sorts put NULLs last (the reference's database does), and every
top-k ends in an ``orderBy(...).limit(n)`` so Spark plans it as a
per-partition top-k followed by a small merge (``TakeOrderedAndProject``),
never a global sort of the status table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.dates import ts_lit

# Fixed values of the reference's selection policy.
RUN_KEY_LIMIT = 100          # keys per incremental run
NOT_FOUND_RETRY_DAYS = 15    # a not-found key is retried after this many days
STALE_AFTER_DAYS = 30        # product data older than this is refreshed

def _before(as_of: dt.datetime, days: int):
    return ts_lit(as_of - dt.timedelta(days=days))


def visible_asins(catalog: DataFrame, ordered: bool = False) -> DataFrame:
    """SEL-1: distinct visible, non-empty keys. ``ordered`` sorts them, for
    reports; the runs join them and need no order."""
    keys = (catalog.filter(F.col("product_visibility") & F.col("asin").isNotNull() & (F.col("asin") != ""))
            .select("asin").distinct())
    return keys.orderBy("asin") if ordered else keys


def new_candidates(status: DataFrame, as_of: dt.datetime,
                   retry_days: int = NOT_FOUND_RETRY_DAYS) -> DataFrame:
    """SEL-2 filter: never fetched, or not found and the retry wait is over.
    A NULL flag is not a candidate (three-valued ``= false``)."""
    attempted = F.col("product_fetch_attempted_at")
    return status.filter((F.col("has_product_data") == F.lit(False))
                         & (attempted.isNull() | (attempted < _before(as_of, retry_days))))


def stale_candidates(status: DataFrame, as_of: dt.datetime,
                     stale_days: int = STALE_AFTER_DAYS) -> DataFrame:
    """SEL-3 filter: product data present and older than the stale limit."""
    synced = F.col("product_data_synced_at")
    return status.filter((F.col("has_product_data") == F.lit(True)) & synced.isNotNull()
                         & (synced < _before(as_of, stale_days)))


def select_new(status: DataFrame, as_of: dt.datetime, limit: int = RUN_KEY_LIMIT) -> DataFrame:
    """SEL-2: oldest-created new candidates first; NULL created_at last."""
    return (new_candidates(status, as_of)
            .orderBy(F.col("created_at").asc_nulls_last(), F.col("asin").asc_nulls_last())
            .limit(limit)
            .select("asin", F.lit(True).alias("is_new"), "sales_estimate_data_synced_at"))


def select_stale(status: DataFrame, as_of: dt.datetime, limit: int = RUN_KEY_LIMIT) -> DataFrame:
    """SEL-3: oldest product data first. ``asin`` breaks ties, which the
    reference leaves undefined."""
    return (stale_candidates(status, as_of)
            .orderBy(F.col("product_data_synced_at").asc(), F.col("asin").asc())
            .limit(limit)
            .select("asin", F.lit(False).alias("is_new"), "sales_estimate_data_synced_at"))


def select_priority(status: DataFrame, as_of: dt.datetime, limit: int = RUN_KEY_LIMIT) -> DataFrame:
    """SEL-4: new keys first, stale keys fill what is left of ``limit``.

    One plan instead of two dependent queries: tag each side with a
    priority, union, and take the first ``limit`` by (priority, age, asin).
    Equal to "take new up to limit, then stale up to limit - |new|".
    """
    new = new_candidates(status, as_of).select(
        "asin", F.lit(0).alias("priority"), F.col("created_at").alias("sort_ts"),
        "sales_estimate_data_synced_at")
    stale = stale_candidates(status, as_of).select(
        "asin", F.lit(1).alias("priority"), F.col("product_data_synced_at").alias("sort_ts"),
        "sales_estimate_data_synced_at")
    return (new.unionByName(stale)
            .orderBy("priority", F.col("sort_ts").asc_nulls_last(), F.col("asin").asc_nulls_last())
            .limit(limit)
            .select("asin", (F.col("priority") == 0).alias("is_new"), "sales_estimate_data_synced_at"))


def needs_product(status: DataFrame, ordered: bool = False) -> DataFrame:
    """SEL-5: full run product step: flag false or NULL (``ordered``: by key)."""
    keys = status.filter(~F.coalesce(F.col("has_product_data"), F.lit(False))).select("asin")
    return keys.orderBy("asin") if ordered else keys


def needs_sales(status: DataFrame, ordered: bool = False) -> DataFrame:
    """SEL-6: full run sales step: product true and sales exactly false (``ordered``: by key)."""
    keys = status.filter((F.col("has_product_data") == F.lit(True))
                         & (F.col("has_sales_data") == F.lit(False))).select("asin")
    return keys.orderBy("asin") if ordered else keys


def errored_asins(status: DataFrame) -> DataFrame:
    """SEL-7: rows carrying an error."""
    return status.filter(F.col("error").isNotNull()).select("asin", "error")


def retry_backlog(status: DataFrame, retry_days: int = NOT_FOUND_RETRY_DAYS) -> DataFrame:
    """SEL-8: keys without product data that were tried, with the earliest
    time they become eligible again."""
    return (status.filter((F.col("has_product_data") == F.lit(False))
                          & F.col("product_fetch_attempted_at").isNotNull())
            .select("asin", "product_fetch_attempted_at",
                    (F.col("product_fetch_attempted_at") + F.expr(f"INTERVAL {retry_days} DAYS"))
                    .alias("retry_after")))


# --- joins against the visible catalog ----------------------------------

def cleanup_kept(status: DataFrame, visible: DataFrame) -> DataFrame:
    """JN-1 survivors: status rows whose key is still visible."""
    return status.join(visible, "asin", "left_semi")


def cleanup_deleted(status: DataFrame, visible: DataFrame) -> DataFrame:
    """JN-1 deletions: status rows whose key is no longer visible."""
    return status.join(visible, "asin", "left_anti")


def add_new_keys(visible: DataFrame, status: DataFrame, as_of: dt.datetime) -> DataFrame:
    """JN-2: visible keys missing from status, as new rows with both flags
    false and the table defaults for the rest."""
    ts = ts_lit(as_of)
    null_ts = F.lit(None).cast("timestamp_ntz")
    return (visible.join(status.select("asin"), "asin", "left_anti")
            .select("asin", F.lit(False).alias("has_product_data"), F.lit(False).alias("has_sales_data"),
                    F.lit(None).cast("string").alias("error"),
                    null_ts.alias("product_data_synced_at"), null_ts.alias("sales_estimate_data_synced_at"),
                    null_ts.alias("product_fetch_attempted_at"), ts.alias("created_at"), ts.alias("updated_at")))


def not_found(requested: DataFrame, returned: DataFrame) -> DataFrame:
    """JN-3 / SET-2: requested keys the response did not contain."""
    return requested.select("asin").join(returned.select("asin"), "asin", "left_anti")


def attach_sync_info(selection: DataFrame, stored: DataFrame) -> DataFrame:
    """JN-4: attach the selection's last-sales-sync to stored keys. The
    selection is bounded by the run limit, so it is broadcast; keys without
    selection info are skipped (inner join)."""
    return stored.select("asin").join(F.broadcast(selection), "asin", "inner")


def keyword_topk(keywords: DataFrame, by: str = "monthly_search_volume_exact", k: int = 10) -> DataFrame:
    """SEL-10: top-k keywords by a metric (descending, id breaks ties)."""
    return keywords.orderBy(F.col(by).desc_nulls_last(), F.col("id").asc()).limit(k)


def keyword_topk_by_country(keywords: DataFrame, by: str = "monthly_search_volume_exact",
                            k: int = 3) -> DataFrame:
    """SEL-10 per country: ``row_number`` over a window partitioned by
    country. Spark inserts a per-partition group limit before the shuffle
    (WindowGroupLimit), so only k rows per country and partition move."""
    w = Window.partitionBy("country").orderBy(F.col(by).desc_nulls_last(), F.col("id").asc())
    return (keywords.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .filter(F.col("rank") <= k))
