"""Operators 6, 7 and 10: DataFrame functions, compared with DuckDB and by hand."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quayside.llm import exact, lines, mixing, queries
from quayside.testing import compare, duck_connect
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, small_dir, name):
    r = compare(queries.QUERIES[name](spark, small_dir), queries.ORACLES[name], small_dir, duck_connect(small_dir))
    assert r["values_match"], r


@pytest.mark.parametrize("name", ["op6_line_dedup", "op7_mix_sources"])
def test_native_queries_have_no_python(spark, small_dir, name):
    plan = plan_of(queries.QUERIES[name](spark, small_dir))
    assert not [w for w in ("Python", "Pandas", "Arrow") if w in plan]


def test_exact_cases(spark):
    rows = [(1, "a", None, None), (5, "a", "en", "s"), (3, "a", None, None), (2, None, None, None), (4, "", None, None),
            (6, "A", None, None), (None, "z", None, None), (7, "z", None, None), (8, "q", None, None), (8, "q", None, None)]
    got = sorted(map(tuple, exact.exact_groups(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    want = sorted([(1, 5, 3, False, sha("a")), (5, 5, 3, True, sha("a")), (3, 5, 3, False, sha("a")),
                   (2, 4, 2, False, sha("")), (4, 4, 2, True, sha("")), (6, 6, 1, True, sha("A")),
                   (None, 7, 2, False, sha("z")), (7, 7, 2, True, sha("z")), (8, 8, 2, True, sha("q")),
                   (8, 8, 2, True, sha("q"))], key=str)
    assert got == want


def test_exact_collisions_are_told_apart(spark):
    rows = [(i, "ab"[i % 2] * 3 + "c" * (i // 6), None, None) for i in range(24)]
    docs = spark.createDataFrame(rows, DOCS)
    weak = exact.exact_groups(docs, hash_of=lambda t: F.length(t))
    assert sorted(map(tuple, weak.collect())) == sorted(map(tuple, exact.exact_groups(docs).collect()))


def test_exact_smallest_and_empty(spark):
    docs = spark.createDataFrame([(1, "a", None, None), (2, "a", None, None)], DOCS)
    assert {r["doc_id"]: r["kept"] for r in exact.exact_groups(docs, keep="smallest").collect()} == {1: True, 2: False}
    assert exact.exact_groups(docs.where("false")).collect() == []
    with pytest.raises(ValueError):
        exact.exact_groups(docs, keep="first")


def test_drop_exact_copies_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", "x", 1), (2, "a", "y", 2), (3, None, "z", 3)],
                                 "doc_id long, text string, row string, h long")
    out = exact.drop_exact_copies(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(2, "a", "y", 2), (3, None, "z", 3)]


def test_drop_exact_copies_keeps_one_of_repeated_rows(spark):
    rows = [(8, "q", None, None), (8, "q", None, None), (7, "q", None, None), (8, "own", None, None), (None, "n", None, None),
            (None, "n", None, None), (9, None, None, None), (9, "", None, None), (1, "single", None, None)]
    got = exact.drop_exact_copies(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(((r["doc_id"], r["text"] or "") for r in got), key=str) == sorted(
        [(8, "q"), (8, "own"), (None, "n"), (9, ""), (1, "single")], key=str)


def test_lines_against_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    long = "  The Common Line Of Many Documents\t"
    extra = [(10**6 + i, f"{long}\nown line number {i} of document\n\n{long.lower()}", None, None) for i in range(40)]
    extra += [(10**7, None, None, None), (10**7 + 1, "", None, None), (10**7 + 2, "\n\n", None, None),
              (10**7 + 3, (long + "\n") * 3000, None, None)]
    docs = docs.select("doc_id", "text", "lang", "source").unionByName(spark.createDataFrame(extra, DOCS))
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in lines.dedup_lines(docs).collect()}
    assert got == brute.without_lines([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert lines.dedup_lines(docs.where("false")).collect() == []


def test_mixing_targets(spark):
    rows = [(i, "w " * 10, None, s) for i, s in enumerate("aaaaaaaabbbbcc")] + [(90, "w " * 10, None, None), (91, None, None, "empty")]
    got = mixing.mix_plan(spark.createDataFrame(rows, DOCS)).collect()
    targets = {(r["source_size"], round(r["target"], 6)) for r in got}
    # Sources a, b, c, empty, null weigh 3, 1, 2, 3, 1 of 225 words; b 40 words, c 20, null 10.
    total = 80 + 40 + 20 + 10
    assert abs(sum(t for _, t in targets) - 1.5 * total) < 1e-6
    assert all(t <= 2 * s + 1e-9 for s, t in targets)
    assert (0, 0.0) in targets and (20, 40.0) in targets
    assert all(r["copies"] <= 2 for r in got)


def test_mixing_comes_near_its_targets_and_repeats(spark):
    rows = [(i, "w " * (1 + i % 7), None, "abc"[min(i % 9, 2)]) for i in range(6000)]
    docs = spark.createDataFrame(rows, DOCS)
    plan = mixing.mix_plan(docs)
    sums = plan.groupBy("source_size", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("t")).collect()
    assert all(abs(r["t"] - r["target"]) < 0.05 * r["target"] for r in sums)
    assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, mixing.mix_plan(docs.repartition(7)).collect()))
    taken = mixing.mix(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r["copies"] for r in plan.collect())


def test_mixing_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    assert mixing.mix_plan(docs).collect() == [] and mixing.mix(docs).collect() == []


def test_sources_are_numbered_by_code_point(spark):
    from quayside.llm.common import Stager
    names = ["b", "a", "Z", "é", None, "zz", ""]
    got = mixing.numbered(Stager(spark), spark.createDataFrame([(n,) for n in names], "source string"), "source")
    order = [r["source"] for r in sorted(got.collect(), key=lambda r: r["number"])]
    assert order == sorted((n for n in names if n is not None), key=lambda s: s.encode()) + [None]
