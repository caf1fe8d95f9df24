"""Batch numbering, last-write-wins dedupe and the stop rule (WIN-1..3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import ensure_checkpoint_dir

BATCH_SIZE = 100  # keys per product request, rows per bulk write (fixed value)

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: record number in the low 33 bits


def plan_batches(keys: DataFrame, key: str = "asin", batch_size: int = BATCH_SIZE,
                 num_partitions: int | None = None) -> DataFrame:
    """WIN-1: number the sorted keys and cut them into batches.

    A global ``row_number()`` would pull every key into one task. Instead
    the keys are range-partitioned and sorted inside each partition; the
    position inside a partition comes from ``monotonically_increasing_id``
    (partition index in the high bits, record number in the low 33 bits),
    and each partition's offset from a tiny per-partition count table
    (one row per partition, so its broadcast is bounded by the partition
    count, not the data). Output: key, ``position`` (1-based),
    ``batch_no``, ``batch_count`` = ceil(n / batch_size).
    """
    spark = keys.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Numbered once and checkpointed (reliable, in the shared checkpoint
    # folder): both uses below read the same ids, and a lost executor does
    # not recompute the numbering.
    ranged = (keys.select(key).repartitionByRange(n, F.col(key).asc_nulls_last())
              .sortWithinPartitions(F.col(key).asc_nulls_last())
              .withColumn("_mid", F.monotonically_increasing_id())
              .select(key, F.shiftright("_mid", 33).alias("_part"),
                      F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)).alias("_local"))
              .checkpoint(eager=True))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                            F.sum("_n").over(whole).alias("_total"))
    pos = F.col("_offset") + F.col("_local") + 1
    return (ranged.join(F.broadcast(offsets), "_part")
            .select(key, pos.alias("position"),
                    (F.floor((pos - 1) / batch_size) + 1).cast("bigint").alias("batch_no"),
                    F.ceil(F.col("_total") / batch_size).cast("bigint").alias("batch_count")))


def dedupe_last(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """WIN-2 / UPS-6: keep the row with the highest ``seq`` per key (the
    last of a sequence of row-by-row upserts).

    ``max_by(struct(row), seq)`` is an aggregate, so it is computed
    partially before the shuffle: a key holding a third of all rows costs
    one partial row per input partition, not a skewed window partition.
    """
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.col(seq)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def duplicate_key_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (for ``on_duplicate='error'``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


STOP_BLOCK = 100_000  # batch numbers per block of the stop-rule scan


def stop_point(batch_log: DataFrame, run: str = "run_id", limit: int = 3, block_size: int = STOP_BLOCK) -> DataFrame:
    """WIN-3: the batch at which a run stops: ``limit`` consecutive
    processed batches that returned rows but stored none. Any other
    processed batch resets the streak; batches whose fetch failed neither
    count nor reset. Runs that never stop get ``stop_batch`` NULL.

    A two-level scan, so no run is ever one window partition:
    1. Batch numbers are cut into blocks of ``block_size``. Inside a block
       (a window of at most ``block_size`` rows) islands between resets give
       each row its streak; a block is summarised by its row count, whether it
       has a reset, the positions of its first ``limit`` leading failures, the
       first in-block stop after a reset, and its trailing streak.
    2. Per run, over the block summaries (one row per block), the streak
       carried into each block is the sum over its segment (the last block
       with a reset contributes its trailing streak, later all-failure blocks
       their row counts). A block stops the run at its (limit - carry)-th
       leading failure, or at its own in-block stop; the earliest wins.
    """
    fail = (F.col("returned") > 0) & (F.col("stored") == 0)
    x = (batch_log.filter(~F.col("fetch_failed"))
         .select(run, "batch_no", fail.alias("_f"), F.floor(F.col("batch_no") / block_size).alias("_blk")))
    upto = Window.unboundedPreceding
    wb = Window.partitionBy(run, "_blk").orderBy("batch_no").rowsBetween(upto, 0)
    x = x.withColumn("_island", F.sum((~F.col("_f")).cast("int")).over(wb))
    wi = Window.partitionBy(run, "_blk", "_island").orderBy("batch_no").rowsBetween(upto, 0)
    x = x.withColumn("_streak", F.sum(F.col("_f").cast("int")).over(wi))

    lead = [F.min(F.when((F.col("_island") == 0) & (F.col("_streak") == k), F.col("batch_no"))).alias(f"_lead{k}")
            for k in range(1, limit + 1)]
    blocks = x.groupBy(run, "_blk").agg(
        F.count(F.lit(1)).alias("_n"), (F.max("_island") == 0).alias("_all_fail"), *lead,
        F.min(F.when((F.col("_island") > 0) & (F.col("_streak") >= limit), F.col("batch_no"))).alias("_local"),
        F.max_by("_streak", "batch_no").alias("_trail"))

    wr = Window.partitionBy(run).orderBy("_blk")
    blocks = blocks.withColumn("_seg", F.sum((~F.col("_all_fail")).cast("int")).over(wr.rowsBetween(upto, 0)))
    ws = Window.partitionBy(run, "_seg").orderBy("_blk").rowsBetween(upto, 0)
    blocks = blocks.withColumn("_end", F.sum(F.when(F.col("_all_fail"), F.col("_n")).otherwise(F.col("_trail"))).over(ws))
    blocks = blocks.withColumn("_carry", F.coalesce(F.lag("_end", 1).over(wr), F.lit(0)))

    need = F.lit(limit) - F.col("_carry")
    carried = None
    for k in range(1, limit + 1):
        carried = (F.when(need == k, F.col(f"_lead{k}")) if carried is None
                   else carried.when(need == k, F.col(f"_lead{k}")))
    candidate = F.when(F.col("_carry") < limit, F.least(carried, F.col("_local")))
    stops = blocks.groupBy(run).agg(F.min(candidate).alias("stop_batch"))
    runs = batch_log.select(run).distinct()
    return runs.join(stops, run, "left")
