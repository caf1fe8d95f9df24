"""Exact deduplication (operator 10): 128-bit content hash, byte comparison inside groups.

1. Rows are counted per content hash (partial sums, so a group holding a
   third of all rows is combined before the shuffle).
2. Each row joins its group on the hash. The group side is one row per hash
   with two members or more, so AQE splits a hot group over many tasks. It
   grows with the input, so it is merged and never broadcast.
3. Inside a group every text is compared, byte by byte, with the text of the
   group's first choice. Rows that differ (a hash collision) are grouped by
   their text itself.

Cases: a null text counts as empty. A null id orders below every id. Rows
that repeat both id and text share a verdict and all count in the size. An
empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Stager, keep_rows, text_of


def content_hash(text: Column) -> Column:
    """128 bits of the text: its MD5 digest as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(docs: DataFrame, hash_of: Callable[[Column], Column] = content_hash,
                 keep: str = "largest") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` names the id that stays of equal texts: ``largest`` or
    ``smallest``.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep}")
    first = F.max if keep == "largest" else F.min
    stage = Stager(docs.sparkSession)
    keyed = docs.select("doc_id", text_of(docs).alias("t")).withColumn("h", hash_of(F.col("t")))
    groups = stage(keyed.groupBy("h").agg(first("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1"), "groups")
    rows = stage(keyed.join(groups.hint("merge"), "h", "left").select(
        "doc_id", "h", "keep_id", "n", F.sha2(F.col("t").cast("binary"), 256).alias("text_sha256"),
        F.when(F.col("n").isNotNull(), F.col("t")).alias("t")), "rows")
    single = rows.where("n IS NULL").select("doc_id", F.col("doc_id").alias("keep_id"),
                                            F.lit(1).cast("long").alias("group_size"), "text_sha256")
    several = rows.where("n IS NOT NULL")
    first_text = stage(several.where("doc_id <=> keep_id").groupBy("h").agg(F.max("t").alias("first_t")), "firsts")
    compared = stage(several.join(first_text.hint("merge"), "h", "left").select(
        "doc_id", "h", "keep_id", "n", "text_sha256",
        F.when(F.col("t") != F.col("first_t"), F.col("t")).alias("other_t")), "compared")
    other = compared.where("other_t IS NOT NULL")
    lost = stage(other.groupBy("h").agg(F.count(F.lit(1)).alias("lost")), "collisions")
    equal = (compared.where("other_t IS NULL").join(lost, "h", "left")
             .select("doc_id", "keep_id", (F.col("n") - F.coalesce("lost", F.lit(0))).alias("group_size"),
                     "text_sha256"))
    apart = stage(other.groupBy("h", "other_t").agg(first("doc_id").alias("apart_id"),
                                                    F.count(F.lit(1)).alias("group_size")), "apart")
    unequal = (other.join(apart, ["h", "other_t"])
               .select("doc_id", F.col("apart_id").alias("keep_id"), "group_size", "text_sha256"))
    return (single.unionByName(equal).unionByName(unequal)
            .select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256"))


def drop_exact_copies(docs: DataFrame, **kwargs) -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` drops, and with one of the rows that repeat
    both the id and the text it keeps; all columns kept."""
    stage = Stager(docs.sparkSession)
    judged = exact_groups(docs, **kwargs).where("group_size > 1").withColumnRenamed("text_sha256", "digest")
    verdicts = stage(judged.groupBy("doc_id", "digest").agg(F.max("kept").alias("keep"), F.count(F.lit(1)).alias("n"))
                     .where("NOT keep OR n > 1").select("doc_id", "digest", "keep"), "verdicts")
    return keep_rows(docs, docs["doc_id"], F.sha2(text_of(docs).cast("binary"), 256), verdicts)
