"""The pipeline's stages, each judged on its own input."""

import corpus_pipeline
from pyspark.sql import functions as F

from quayside.llm import queries
from quayside.llm.common import Stager
from tests.llm import brute


def test_stages(spark, small_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "packing"]
    stage = Stager(spark)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, small_dir), name)
        if name == "packing":
            break
        assert docs.columns == columns
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        after = dict(rows)
        assert all(before[i] == t for i, t in rows)
        if name == "exact_dedup":
            assert sorted(after) == sorted({t: i for i, t in sorted(before.items())}.values())
        elif name == "jaccard_join":
            groups = brute.similar_groups(sorted(before.items()), 5, 80)
            assert sorted(after) == sorted({c for _, c in groups.values()})
        elif name == "mixing":
            assert all(sum(1 for j, _ in rows if j == i) <= 2 for i in after)
        before = after
    used = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert used.where("n > 2048").count() == 0
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == set(before)


def test_registered(spark, small_dir):
    assert queries.QUERIES["pipeline"](spark, small_dir).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_rest_does_not_import_the_subpackage():
    import pathlib
    import re
    top = pathlib.Path(corpus_pipeline.__file__).parent
    for path in top.glob("quayside/**/*.py"):
        if "llm" not in path.relative_to(top).parts:
            assert not re.search(r"quayside\.llm|from quayside import .*llm", path.read_text()), path
