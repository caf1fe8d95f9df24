"""Landed API documents -> typed rows (SRC-1..3, SRC-6, SRC-7).

Two entry points per document kind: files (``spark.read.json`` with a
declared schema, one document per line or ``multi_line``) and a text column
already landed in a table (``from_json``). Both keep ``_corrupt_record`` so a
bad document is quarantined whole, as the reference rejects a response that
fails to decode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.schemas import CORRUPT, KEYWORD_DOC, PRODUCT_DOC, PRODUCT_DOC_VARIANT, SALES_DOC

DOC_SCHEMAS = {"product": PRODUCT_DOC, "product_variant": PRODUCT_DOC_VARIANT, "sales": SALES_DOC,
               "keyword": KEYWORD_DOC}


def read_payload_files(spark: SparkSession, path: str, kind: str, multi_line: bool = False,
                       mode: str = "PERMISSIVE") -> DataFrame:
    """Read JSON documents of ``kind`` from files. ``mode='FAILFAST'``
    raises on the first bad document instead of quarantining it."""
    reader = (spark.read.schema(DOC_SCHEMAS[kind]).option("mode", mode)
              .option("columnNameOfCorruptRecord", CORRUPT))
    if multi_line:
        reader = reader.option("multiLine", True)
    return reader.json(path).withColumn("source_file", F.col("_metadata.file_path"))


def parse_payloads(docs: DataFrame, kind: str, text_col: str = "doc", mode: str = "PERMISSIVE") -> DataFrame:
    """Parse a column of JSON text into ``data`` (+ ``_corrupt_record``);
    the other input columns are carried along. ``mode='FAILFAST'`` makes
    the first bad document fail the job instead of being quarantined."""
    parsed = F.from_json(F.col(text_col), DOC_SCHEMAS[kind],
                         {"mode": mode, "columnNameOfCorruptRecord": CORRUPT})
    keep = [c for c in docs.columns if c != text_col]
    return docs.select(*keep, parsed.alias("_p")).select(*keep, "_p.data", F.col(f"_p.{CORRUPT}").alias(CORRUPT))


def read_product_payloads(docs: DataFrame, text_col: str = "doc", free_form: str = "struct") -> DataFrame:
    """SRC-1. ``free_form='variant'`` reads the two free maps
    (subcategory ranks, fee breakdown) as ``VariantType`` instead of the
    declared structs, keeping keys the schema does not know."""
    return parse_payloads(docs, "product_variant" if free_form == "variant" else "product", text_col)


def read_sales_payloads(docs: DataFrame, text_col: str = "doc") -> DataFrame:
    """SRC-2."""
    return parse_payloads(docs, "sales", text_col)


def read_keyword_payloads(docs: DataFrame, text_col: str = "doc") -> DataFrame:
    """SRC-3."""
    return parse_payloads(docs, "keyword", text_col)


def is_corrupt():
    return F.col(CORRUPT).isNotNull() | F.col("data").isNull()


def good_documents(parsed: DataFrame) -> DataFrame:
    """Documents that decoded and hold at least one item."""
    return parsed.filter(~is_corrupt() & (F.size("data") > 0)).drop(CORRUPT)


def quarantine(parsed: DataFrame) -> DataFrame:
    """SRC-6: documents that failed to decode (bad syntax or a value of the
    wrong type); the whole document is rejected, with its text."""
    return parsed.filter(is_corrupt()).select(
        *[c for c in parsed.columns if c not in ("data", CORRUPT)],
        F.lit("parse_error").alias("reason"), F.col(CORRUPT).alias("raw"))


def empty_documents(parsed: DataFrame) -> DataFrame:
    """SRC-7: decoded documents without items: an ``empty_response`` error,
    distinct from a parse failure."""
    return parsed.filter(~is_corrupt() & (F.size("data") == 0)).select(
        *[c for c in parsed.columns if c not in ("data", CORRUPT)], F.lit("empty_response").alias("reason"))


def document_summary(parsed: DataFrame) -> DataFrame:
    """One row per document: item count and outcome."""
    outcome = F.when(is_corrupt(), "parse_error").when(F.size("data") == 0, "empty_response").otherwise("ok")
    return parsed.select(*[c for c in parsed.columns if c not in ("data", CORRUPT)],
                         F.when(is_corrupt(), F.lit(None).cast(T.IntegerType())).otherwise(F.size("data"))
                         .alias("n_items"), outcome.alias("outcome"))
