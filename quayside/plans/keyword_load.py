"""The keyword load: landed documents -> rows -> insert what is new -> access paths (SRC-3, FLT-3, UPS-4, SEL-10).

An existing id wins, and of rows that share an id the first in document order.
A load writes its new rows as one folder of the table and touches no other; it
reads the ids of the rest only. A repeated load replaces its own folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import flatten as flt
from quayside.operators import upsert as ups
from quayside.schemas import KEYWORD_COLUMNS, KEYWORD_METRICS, METRIC
from quayside.sinks import keyword_paths
from quayside.sinks.publish import Target, publish_one, read_live
from quayside.sources import payloads

KEYWORDS = "keywords_data"
LOAD = "load"
TABLE = T.StructType([T.StructField(c, METRIC if c in KEYWORD_METRICS else T.TimestampNTZType() if c == "updated_at"
                                    else T.StringType()) for c in KEYWORD_COLUMNS])
STORED = T.StructType([*TABLE.fields, T.StructField(LOAD, T.StringType())])


def load_keywords(docs: DataFrame, target: Target, version: str) -> DataFrame:
    """Load ``docs`` (a ``doc`` column and columns that give the documents' order); returns a one-row summary:
    version, documents, bad_documents, empty_documents, items, without_id, inserted, ignored.

    A document that does not decode is left out whole; an item without an id cannot be stored. Items that are there
    already, or come a second time, are ignored. No documents: a summary of zeros, and the table is as it was."""
    spark = docs.sparkSession
    part = f"load-{uuid.uuid5(uuid.NAMESPACE_URL, version).hex}"
    parsed = payloads.read_keyword_payloads(docs).checkpoint(eager=True)
    order = flt.document_order(parsed)
    if not order:
        raise ValueError("documents need columns that give their order, for first-wins rows")
    rows = flt.flatten_keywords(payloads.good_documents(parsed), order=order)
    known = read_live(spark, target, KEYWORDS, STORED).where(F.col(LOAD) != part).select("id")
    new = (ups.prepare_source(rows, ["id"], flt.SEQ, "first").join(known, "id", "left_anti")
           .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLE.fields], F.lit(part).alias(LOAD)))
    publish_one(new, target, KEYWORDS, version, partition_by=LOAD, merge_partitions=True, replaced={part})
    c = payloads.document_summary(parsed).agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.col("outcome") == "parse_error").alias("bad"),
        F.count_if(F.col("outcome") == "empty_response").alias("empty"),
        F.coalesce(F.sum("n_items"), F.lit(0)).alias("items")).first()
    without = rows.where(F.col("id").isNull()).count()
    inserted = read_live(spark, target, KEYWORDS, STORED).where(F.col(LOAD) == part).count()
    return spark.createDataFrame(
        [(version, c.documents, c.bad, c.empty, c["items"], without, inserted, c["items"] - without - inserted)],
        "version string, documents long, bad_documents long, empty_documents long, items long, without_id long, "
        "inserted long, ignored long")


def write_access_paths(spark: SparkSession, target: Target, root: str) -> None:
    """The layouts of the stored keywords that the lookups read, under a folder of their own."""
    keyword_paths.write_paths(read_live(spark, target, KEYWORDS, STORED).select(*TABLE.fieldNames()), root)
