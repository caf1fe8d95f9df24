"""Helpers shared by the operators: reading, staging in the shared folder, keeping whole rows."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import ensure_checkpoint_dir

# White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once, so that tasks in Python can import it wherever it is installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    # The driver serves the file for as long as it runs; executors do not read this folder.
    folder = tempfile.mkdtemp(prefix="quayside-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"quayside-{uuid.uuid4().hex[:8]}.zip")
    with open(path, "wb") as f:
        f.write(packed.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


class Stager:
    """Writes intermediate tables as Parquet in the shared checkpoint folder and reads them back.

    Lineage ends at each staged table: a lost executor costs only tasks that
    read it, and nothing is recomputed from the input. Every run has a folder
    of its own, ``<spark.checkpoint.dir>/llm/<uuid>``; results are lazy and
    read from it, so it is for the caller to expire (``folder`` names it).
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}"
        self._n = 0

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        self._n += 1
        path = f"{self.folder}/{self._n:02d}-{label}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(df[column], F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """The row as one struct, so that helper columns cannot clash with its own."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns])


def keep_rows(docs: DataFrame, doc_id: Column, digest: Column, verdicts: DataFrame) -> DataFrame:
    """``docs`` without what ``verdicts`` drops, all columns kept.

    ``verdicts`` (doc_id, digest, keep) names each pair to drop, and each pair
    to keep that several rows have: one of those rows stays. A null id equals
    a null id. Rows that ``verdicts`` does not name stay.
    """
    rows = docs.select(whole_row(docs).alias("row"), doc_id.alias("id"), digest.alias("key"))

    def hit(v):
        return F.col("id").eqNullSafe(v["doc_id"]) & (F.col("key") == v["digest"])

    single = rows.join(verdicts.hint("merge"), hit(verdicts), "left_anti").select("row.*")
    repeated = verdicts.where("keep")
    if repeated.isEmpty():
        return single
    once = rows.join(repeated, hit(repeated), "left_semi").groupBy("id", "key").agg(F.any_value("row").alias("row"))
    return single.unionByName(once.select("row.*"))
