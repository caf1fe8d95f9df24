"""Mixing sources to target weights (operator 7), DataFrame functions only.

1. Words are counted per document and summed per source (partial sums).
2. Sources, ordered by code point with null last, take the weights in turn. A
   source's number is its place in a range partition plus the rows of the
   partitions before it, so no task sorts all sources.
3. Targets share ``share`` of all words by weight. A source stops at
   ``max_rate`` times its size; the rest is shared again by weight until no
   target is above. Each round sends two sums to the driver.
4. A document is emitted floor(rate) times, and once more when its hash, read
   as a number in [0, 1), is below the fraction.

Cases: a null text has no words. Sources without words have target 0 and rate
0. Rows that repeat an id and size share a draw; reruns agree. An empty table
gives an empty result. Other columns of the input are not read by
:func:`mix_plan` and are kept by :func:`mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import WORD, Stager, text_of, whole_row

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_RATE = 2.0
SEED = 7


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def numbered(stage: Stager, df: DataFrame, by: str) -> DataFrame:
    """``df`` with ``number``, 0, 1, ... in ascending order of ``by``, null last."""
    order = F.col(by).asc_nulls_last()
    parts = stage(df.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "ranges")
    # One row per range partition: bounded by the number of shuffle partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order))
    return (parts.join(offsets, "part").withColumn("number", F.col("offset") + place - 1)
            .drop("part", "offset"))


def source_targets(stage: Stager, sizes: DataFrame, weights=WEIGHTS, share=SHARE, max_rate=MAX_RATE) -> DataFrame:
    """(source, source_size, target, rate) of ``sizes`` (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("number") % len(weights) + 1).cast("int"))
    named = stage(numbered(stage, totals, "source")
                  .select("source", "source_size", weight.alias("weight"),
                          (F.col("source_size") * F.lit(float(max_rate))).alias("most")), "sources")
    whole = named.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    rest, over = share * float(whole["s"] or 0), float(whole["w"] or 1)
    budget, all_weights = rest, over
    while True:
        fair = F.col("weight") * F.lit(rest) / F.lit(over)
        full = named.where(fair > F.col("most")).agg(F.sum("most").alias("m"), F.sum("weight").alias("w")).first()
        left = budget - float(full["m"] or 0), all_weights - float(full["w"] or 0)
        if left == (rest, over) or left[1] <= 0:
            break
        rest, over = left
    target = F.least(F.col("weight") * F.lit(rest) / F.lit(over), F.col("most"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return stage(named.select("source", "source_size", target.alias("target"), rate.alias("rate")), "targets")


def copies(rate: Column, doc_id: Column, size: Column, seed: int) -> Column:
    """floor(rate), plus one if the row's hash falls below the fraction."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string"), size.cast("string")))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
    whole = F.floor(rate)
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("long")


def mix_plan(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_rate=MAX_RATE, seed=SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies."""
    stage = Stager(docs.sparkSession)
    sizes = stage(docs.select("doc_id", "source", n_words(text_of(docs)).alias("size")), "sizes")
    targets = source_targets(stage, sizes, weights, share, max_rate)
    # No forced broadcast: few sources are broadcast by their checked size, and
    # many are shuffled, where AQE splits a hot one.
    return (sizes.alias("d").join(targets.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")), "left")
            .select("doc_id", "size", "source_size", "target",
                    copies(F.col("rate"), F.col("doc_id"), F.col("size"), seed).alias("copies")))


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_rate=MAX_RATE, seed=SEED) -> DataFrame:
    """The mixed table: each row of ``docs`` as often as the mix takes it, with the same columns."""
    stage = Stager(docs.sparkSession)
    sizes = stage(docs.select("source", n_words(text_of(docs)).alias("size")).groupBy("source")
                  .agg(F.sum("size").alias("size")), "sizes")
    targets = source_targets(stage, sizes, weights, share, max_rate)
    rows = docs.select(whole_row(docs).alias("row"), F.col("source").alias("of"), F.col("doc_id").alias("id"),
                       n_words(text_of(docs)).alias("words"))
    taken = (rows.join(targets.alias("s"), rows["of"].eqNullSafe(F.col("s.source")), "left")
             .withColumn("times", copies(F.col("rate"), F.col("id"), F.col("words"), seed)))
    return (taken.where("times > 0")
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*"))
