"""Upserts by natural key without a table format (UPS-1..6, AGG-10).

``upsert`` is insert-or-update as one declarative plan: a full outer join of
target and source on the key, then per-column choice by hit flags. It returns
the whole new table plus an ``action`` column (inserted / updated /
unchanged) that :func:`upsert_counts` folds into the counts the reference
returns.

Scale: with ``partition_by`` only target partitions the source touches go
through the join (see :func:`split_touched`). The merge join is on the full
natural key, which is unique on both sides after :func:`prepare_source`, so
it has no hot key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quayside.functions.dates import ts_lit
from quayside.operators.batches import duplicate_key_count

INSERTED, UPDATED, UNCHANGED = "inserted", "updated", "unchanged"


class DuplicateKeyError(ValueError):
    pass


def null_key_rows(source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows that cannot be stored because a key part is NULL."""
    return source.filter(~_all([F.col(k).isNotNull() for k in keys]))


def prepare_source(source: DataFrame, keys: list[str], seq: str | None = None,
                   on_duplicate: str = "last") -> DataFrame:
    """UPS-6: resolve duplicate keys. Rows with a NULL key part are left out;
    :func:`null_key_rows` returns them, and the runs record them.

    ``last`` keeps the row with the highest ``seq`` (the row-by-row path of
    the reference) and ``first`` the one with the lowest; both need ``seq``.
    ``error`` raises like one bulk statement touching a row twice (this runs
    one aggregation over the source). ``unique`` is for sources whose keys are
    known to be unique."""
    src = source.filter(_all([F.col(k).isNotNull() for k in keys]))
    if on_duplicate == "error":
        dup = duplicate_key_count(src, keys).limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"source touches key {dup[0].asDict()} more than once")
    elif on_duplicate in ("last", "first"):
        if seq is None:
            raise ValueError(f"on_duplicate={on_duplicate!r} needs seq, the order of the rows")
        others = [c for c in src.columns if c not in keys and c != seq]
        pick = F.max_by if on_duplicate == "last" else F.min_by
        if not others:
            return src.select(*keys).distinct()
        return (src.groupBy(*keys).agg(pick(F.struct(*others), F.col(seq)).alias("_row"))
                .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]))
    elif on_duplicate != "unique":
        raise ValueError("on_duplicate must be last, first, error or unique")
    return src.drop(seq) if seq and seq in src.columns else src


ROWS_PER_TASK = 250_000


def dealt_by_key(staged: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``staged`` (checkpointed: it is counted here) by key, in as many tasks as its rows need.

    Without this a task's share is set by compressed bytes, which say little
    about the memory that sorting and grouping its rows takes: short keys that
    follow one another compress very well. Rows of one key share a task; it
    sorts them on disk if they are many."""
    tasks = max(1, -(-staged.count() // rows_per_task))
    return staged.repartition(tasks, *[F.col(k) for k in keys])


def _all(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def split_touched(target: DataFrame, source: DataFrame, partition_by: list[str]):
    """Target rows in partitions the source touches, and all other rows.

    The source's values of the first partition column (at most one per
    partition folder of the table) become a literal filter, so the scan of a
    partitioned table prunes to the touched folders and other rows pass
    through without a shuffle. Reading them computes the source's partition
    columns once; pass a staged or checkpointed source. Further partition
    columns are matched by a join below that filter.
    """
    first = partition_by[0]
    vals = [r[0] for r in source.select(first).distinct().collect()]
    hit = F.col(first).isin([v for v in vals if v is not None])
    if None in vals:
        hit = hit | F.col(first).isNull()
    hit = F.coalesce(hit, F.lit(False))
    inside, outside = target.filter(hit), target.filter(~hit)
    if len(partition_by) > 1:
        touched = source.select(*[F.col(c).alias(f"_p_{c}") for c in partition_by]).distinct()
        same = _all([F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in partition_by])
        outside = outside.unionByName(inside.join(touched, same, "left_anti"))
        inside = inside.join(touched, same, "left_semi")
    return inside, outside


def upsert(target: DataFrame, source: DataFrame, keys: list[str], *,
           update_cols: Iterable[str] | None = None, keep_cols: Iterable[str] = (),
           touch_cols: Iterable[str] = (), insert_defaults: dict[str, Column] | None = None,
           as_of: dt.datetime | None = None, partition_by: list[str] | None = None,
           seq: str | None = None, on_duplicate: str = "last", touched_only: bool = False) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``.

    * ``update_cols``: taken from the source on conflict (default: every
      source column that is not a key).
    * ``keep_cols``: keep the target's value on conflict; on insert take the
      source's value, or ``insert_defaults[c]`` when the source lacks it.
    * ``touch_cols``: set to ``as_of`` on conflict and on insert (stamps).
    Target columns in none of the lists keep their value (NULL on insert
    unless a default is given). Output columns: target's, then ``action``.
    ``touched_only`` (with ``partition_by``) returns only the partitions the
    source touches, ready for a partition-level publish.
    """
    insert_defaults = dict(insert_defaults or {})
    src = prepare_source(source, keys, seq, on_duplicate)
    if update_cols is None:
        update_cols = [c for c in src.columns if c not in keys and c not in set(keep_cols) | set(touch_cols)]
    update_cols, keep_cols, touch_cols = list(update_cols), list(keep_cols), list(touch_cols)
    stamp = ts_lit(as_of) if as_of is not None else None
    if touch_cols and stamp is None:
        raise ValueError("touch_cols need as_of")

    if partition_by:
        t_in, t_out = split_touched(target, src, partition_by)
    else:
        t_in, t_out = target, None

    t = t_in.withColumn("_t", F.lit(True))
    s = src.withColumn("_s", F.lit(True))
    j = t.alias("t").join(s.alias("s"), on=keys, how="full_outer")
    hit_t = F.coalesce(F.col("_t"), F.lit(False))
    hit_s = F.coalesce(F.col("_s"), F.lit(False))

    def src_or_default(c: str) -> Column:
        if c in src.columns:
            return F.col(f"s.{c}")
        if c in insert_defaults:
            return insert_defaults[c]
        return F.lit(None)

    out = []
    for c in target.columns:
        if c in keys:
            expr = F.col(c)
        elif c in touch_cols:
            expr = F.when(hit_s, stamp).otherwise(F.col(f"t.{c}"))
        elif c in update_cols:
            expr = F.when(hit_s, src_or_default(c)).otherwise(F.col(f"t.{c}"))
        else:  # keep_cols and columns the source does not carry
            expr = F.when(hit_t, F.col(f"t.{c}")).otherwise(src_or_default(c))
        out.append(expr.cast(target.schema[c].dataType).alias(c))
    action = F.when(hit_t & hit_s, UPDATED).when(hit_s, INSERTED).otherwise(UNCHANGED)
    merged = j.select(*out, action.alias("action"))
    if t_out is not None and not touched_only:
        merged = merged.unionByName(t_out.withColumn("action", F.lit(UNCHANGED)))
    return merged


def upsert_counts(merged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG-10: inserted and updated row counts of an upsert result."""
    aggs = [F.count_if(F.col("action") == INSERTED).alias("inserted"),
            F.count_if(F.col("action") == UPDATED).alias("updated")]
    return merged.groupBy(*(by or [])).agg(*aggs)


def observed_counts(merged: DataFrame) -> tuple[DataFrame, Observation]:
    """AGG-10 without a plan of its own: the merged rows, ready to write, and an observation that has their
    ``inserted`` and ``updated`` counts once the first write of them is done."""
    seen = Observation()
    counted = merged.observe(seen, F.count_if(F.col("action") == INSERTED).alias("inserted"),
                             F.count_if(F.col("action") == UPDATED).alias("updated"))
    return counted.drop("action"), seen


def key_hits(target: DataFrame, source: DataFrame, keys: list[str], partition_by: list[str] | None = None,
             hits: dict[str, Column] | None = None) -> DataFrame:
    """One row per distinct source key with ``hit`` = the key is already in
    the target: what an upsert would count as updated (hit) or inserted (no
    hit), without computing the merged table. Only key columns are read, and
    only the touched partitions of the target.

    ``hits`` (name -> condition on target rows) asks for several targets that
    are parts of one table in one pass over it: one flag per name, true where
    a row of that part has the key."""
    hits = hits or {"hit": F.lit(True)}
    src = prepare_source(source.select(*keys), keys, on_duplicate="unique").distinct()
    t = split_touched(target, src, partition_by)[0] if partition_by else target
    found = t.groupBy(*keys).agg(*[F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in hits.items()])
    return src.join(found, keys, "left").select(*keys, *[F.coalesce(F.col(n), F.lit(False)).alias(n) for n in hits])


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], seq: str | None = None,
                  on_duplicate: str = "first") -> DataFrame:
    """UPS-4: insert source rows whose key is absent; existing keys win.
    Within the source the first row per key wins (lowest ``seq``), as with
    row-by-row ``ON CONFLICT DO NOTHING``."""
    src = prepare_source(source, keys, seq, on_duplicate)
    new = src.join(target.select(*keys), keys, "left_anti").select(*target.columns)
    return (target.withColumn("action", F.lit(UNCHANGED))
            .unionByName(new.withColumn("action", F.lit(INSERTED))))


# --- table shapes of the reference --------------------------------------

PRODUCT_KEYS = ["asin", "report_date"]
SALES_KEYS = ["asin", "marketplace", "date"]
SALES_UPDATE = ["is_parent", "is_variant", "is_standalone", "parent_asin", "estimated_units_sold",
                "last_known_price"]


def upsert_products(target: DataFrame, source: DataFrame, as_of: dt.datetime,
                    touch_created: bool = False, **kw) -> DataFrame:
    """UPS-1 (code path): every attribute is replaced; ``id`` and
    ``created_at`` keep the stored value. UPS-2 (script path,
    ``touch_created=True``): ``created_at`` is set to now on conflict too."""
    keep = ["id"] + ([] if touch_created else ["created_at"])
    update = [c for c in target.columns if c not in PRODUCT_KEYS + keep + ["created_at"]]
    touch = ["created_at"] if touch_created else []
    defaults = {"created_at": ts_lit(as_of)}
    return upsert(target, source, PRODUCT_KEYS, update_cols=update, keep_cols=keep, touch_cols=touch,
                  insert_defaults=defaults, as_of=as_of, **kw)


def upsert_sales(target: DataFrame, source: DataFrame, as_of: dt.datetime, **kw) -> DataFrame:
    """UPS-3: six columns replaced and ``updated_at`` stamped on conflict;
    ``created_at`` and ``rank`` kept; an insert gets ``rank`` NULL and both
    stamps now."""
    now = ts_lit(as_of)
    return upsert(target, source, SALES_KEYS, update_cols=[c for c in SALES_UPDATE if c in target.columns],
                  keep_cols=["created_at", "rank"], touch_cols=["updated_at"],
                  insert_defaults={"created_at": now, "rank": F.lit(None)}, as_of=as_of, **kw)
