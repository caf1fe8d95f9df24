"""The corpus pipeline: from raw documents to packed training sequences.

Each stage is ``(name, function)``; a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import exact, jaccard, mixing, packing, toxicity
from quayside.llm.common import Stager, table
from quayside.session import prepare


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain random field scores at one half or above go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return exact.drop_exact_copies(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents (five-word shingles, similarity 0.8 or more) one stays."""
    return jaccard.keep_one_of_each(docs, size=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated to their target weights."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are tokenised and packed into sequences of 2048 ids."""
    import public_tokenizers
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_dedup_stage), ("jaccard_join", jaccard_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]

# SQL cannot express the trained tagger or the tokenizer; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    prepare(spark)
    stage = Stager(spark)
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
