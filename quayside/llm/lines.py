"""Line deduplication (operator 6), DataFrame functions only.

1. Lines are normalised and hashed (two chained 64-bit hashes); a document's
   own repeats of a key are taken once, so counting rows counts documents.
2. Documents per key are summed with partial sums; keys under the threshold
   go no further.
3. Lines join the frequent keys; the key side has one row per key, so AQE can
   split a line that a third of all documents hold. Both sides of the joins
   grow with the input, so they are merged and never broadcast. The positions to drop are
   gathered per document and cut out of its line array.

Cases: a null or empty text is one empty line. A null id orders below every
id. Rows that repeat an id count as documents of their own, but the largest id
keeps the line in each of them, and the positions dropped in one of them are
those of its own text. An empty table gives an empty result. Other columns of
the input are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import SPACES, Stager, text_of

MIN_CHARS = 20
MIN_DOCUMENTS = 3


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), string.ascii_uppercase, string.ascii_lowercase)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, text (the lines that stay)."""
    stage = Stager(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("t"))
    # Rows that repeat an id are told apart by their text.
    rows = rows.withColumn("h", F.xxhash64("t"))
    lines = F.split(F.col("t"), "\n", -1)
    keyed = (rows.select("doc_id", "h", F.posexplode(lines).alias("pos", "line"))
             .select("doc_id", "h", "pos", line_key(F.col("line")).alias("key"))
             .where(F.length("key") >= min_chars)
             .select("doc_id", "h", "pos", F.xxhash64("key").alias("k1"),
                     F.xxhash64(F.lit("second"), "key").alias("k2")))
    held = F.array_distinct(F.filter(F.transform(lines, line_key), lambda k: F.length(k) >= min_chars))
    frequent = stage(rows.select("doc_id", F.explode(held).alias("key"))
                     .groupBy(F.xxhash64("key").alias("k1"), F.xxhash64(F.lit("second"), "key").alias("k2"))
                     .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"))
                     .where(F.col("n") >= min_documents).drop("n"), "frequent")
    hits = keyed.join(frequent.hint("merge"), ["k1", "k2"]).where("NOT (doc_id <=> keep_id)").select("doc_id", "h", "pos")
    drops = stage(hits.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set("pos")).alias("drop")), "drops")
    same = rows["doc_id"].eqNullSafe(drops["doc_id"]) & (rows["h"] == drops["h"])
    joined = rows.join(drops.hint("merge"), same, "left").select(rows["doc_id"], "t", "drop", F.size(lines).alias("n_lines"))

    def without_drops(all_lines: Column) -> Column:
        # Between two dropped positions a and b stay the lines a+1 .. b-1.
        runs = F.zip_with(F.concat(F.array(F.lit(-1)), F.col("drop")),
                          F.concat(F.col("drop"), F.array(F.col("n_lines"))),
                          lambda a, b: F.slice(all_lines, a + 2, b - a - 1))
        return F.array_join(F.flatten(runs), "\n")

    # The one-element array binds the split lines once, not once per run.
    kept = F.element_at(F.transform(F.array(lines), without_drops), 1)
    clean = F.col("drop").isNull()
    return joined.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        F.when(clean, 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
        F.when(clean, F.col("t")).otherwise(kept).alias("text"))
