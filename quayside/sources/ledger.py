"""The document ledger: which landed documents a run has dealt with (SRC-1, SRC-2, RPT-1).

A document is known by its file and a digest of its text; where it landed
without a file name, by all its columns. Before a run parses anything, it
leaves out the documents that earlier runs have handled, so it parses and
reports only what is new. A document is handled when it was rejected (it did
not decode or holds no item), or when the run took every key it names. One
with a key the run did not ask for stays open for a later run. A run that is
repeated under its id sees its own documents again: what it does with them
changes nothing the second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.ids import asin_from_id
from quayside.sinks.run_log import RunLog
from quayside.sources import payloads

KEY = "_doc_key"


def document_key(docs: DataFrame, text_col: str = "doc"):
    """A digest that names the document among all that ever land."""
    where = ["file"] if "file" in docs.columns else sorted(c for c in docs.columns if c != text_col)
    return F.sha2(F.to_json(F.struct(*where, text_col)), 256)


def unhandled(docs: DataFrame, log: RunLog, source: str, run: str) -> DataFrame:
    """``docs`` with their key, without those that other runs have handled."""
    done = log.read().where((F.col("source") == source) & (F.col("run") != run)).select(F.col("doc_key").alias(KEY))
    return docs.withColumn(KEY, document_key(docs)).join(done, KEY, "left_anti")


def handled(parsed: DataFrame, keys: DataFrame, source: str, run: str) -> DataFrame:
    """Rows of the log for parsed documents, given the keys that the run took."""
    rejected = payloads.quarantine(parsed).select(KEY, "reason").unionByName(
        payloads.empty_documents(parsed).select(KEY, "reason"))
    good = payloads.good_documents(parsed)
    if source == "sales":  # only the first item of a sales document is ever stored
        named = good.select(KEY, F.get("data", 0)["attributes"]["asin"].alias("asin"))
    else:
        named = good.select(KEY, F.explode("data").alias("item")).select(KEY, asin_from_id(F.col("item.id")).alias("asin"))
    open_ = (named.where("asin IS NOT NULL").join(keys.select("asin").distinct(), "asin", "left_anti")
             .select(KEY).distinct())
    taken = good.select(KEY).join(open_, KEY, "left_anti").withColumn("reason", F.lit("taken"))
    return taken.unionByName(rejected).select(F.lit(source).alias("source"), F.col(KEY).alias("doc_key"),
                                              F.col("reason").alias("outcome"), F.lit(run).alias("run")).distinct()
