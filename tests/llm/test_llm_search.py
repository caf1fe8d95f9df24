"""Operators 11, 12 and 13: nearest neighbours, fill-in-middle, phrases; compared with plain Python."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.llm import hamming, infill, phrases, queries
from tests.llm import brute

VECTORS = "vec_id long, embedding array<float>, label int, query_id string, score string"
DOCS = "doc_id long, text string, lang string, source string, n string, form string, k int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "q", "s") for i, v in rows], VECTORS)


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


# ---- operator 11


def test_codes_within_the_radius_are_all_found():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (400, 5), dtype=np.uint8)
    index = hamming.SubstringIndex(codes)
    asked = rng.integers(0, 256, (30, 5), dtype=np.uint8)
    far = np.bitwise_count(asked[:, None] ^ codes[None]).sum(axis=2)
    for radius in (-1, 0, 3, 4, 9, 14, 40):
        found = index.near(asked, np.full(30, radius))
        assert not (far <= radius)[~found].any()
        if radius < 0:
            assert not found.any()
        if radius == 9:
            assert found.mean() < 0.7


@pytest.mark.parametrize("stretch", [False, True])
def test_nearest_recall(spark, stretch, monkeypatch):
    """Clustered vectors, more rows than the sample and a block; lengths may differ."""
    monkeypatch.setattr(hamming, "SAMPLE", 800)
    monkeypatch.setattr(hamming, "BLOCK", 700)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((40, 48))
    data = centre[rng.integers(0, 40, 3000)] + rng.standard_normal((3000, 48))
    if stretch:
        data *= np.exp(rng.standard_normal((3000, 1)))
    data = data.astype(np.float32)
    got = by_query(hamming.nearest(vectors(spark, [(i, v.tolist()) for i, v in enumerate(data)]), every=30).collect())
    wide = data.astype(float)
    hit = 0
    for q in range(0, 3000, 30):
        product = wide @ wide[q]
        product[q] = -np.inf
        assert len(got[q]) == 20
        assert all(abs(s - product[i]) < 1e-9 * max(1, abs(s)) for i, s in got[q])
        hit += len({i for i, _ in got[q]} & set(np.argsort(-product)[:20].tolist()))
    assert hit >= 0.95 * 20 * 100


def test_nearest_query_recall(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir.replace('0.001', '0.01')}/embeddings.parquet").toArrow()
    wide = np.array(rows["embedding"].to_pylist(), dtype=float)
    ids = rows["vec_id"].to_numpy()
    got = by_query(queries.QUERIES["op11_multi_index_hashing"](spark, small_dir.replace("0.001", "0.01")).collect())
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hit = 0
    for q, found in got.items():
        product = wide @ wide[ids == q][0]
        product[ids == q] = -np.inf
        hit += len({i for i, _ in found} & set(ids[np.argsort(-product)[:20]].tolist()))
    assert hit >= 0.9 * 20 * len(got)


def test_nearest_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (None, [1.0, 1.0]), (3, [-5.0, 0.0]), (4, None),
            (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [None, 1.0]), (9, [1.0]), (10, []),
            (0, [9.0, 9.0]), (20, [0.0, -0.5])]
    got = by_query(hamming.nearest(vectors(spark, rows), k=5).collect())
    # Id 0 is answered once, by [1, 0]; no row of its own id; ties by id, a null id last.
    assert got == {0: [(1, 1.0), (2, 1.0), (None, 1.0), (20, 0.0), (3, -5.0)],
                   20: [(0, 0.0), (3, 0.0), (1, -0.5), (2, -0.5), (None, -0.5)]}
    assert hamming.nearest(vectors(spark, rows).where("false")).collect() == []
    assert hamming.nearest(vectors(spark, [(0, [1.0, 2.0])])).collect() == []


def test_nearest_equal_rows(spark):
    """A third of the rows is one vector: ties go to the smaller ids."""
    rng = np.random.default_rng(3)
    one = rng.standard_normal(16).astype(np.float32).tolist()
    rows = [(i, one if i % 3 == 0 else rng.standard_normal(16).astype(np.float32).tolist()) for i in range(600)]
    got = by_query(hamming.nearest(vectors(spark, rows), every=300).collect())
    assert [i for i, _ in got[0]] == [3 * k for k in range(1, 21)]
    assert [i for i, _ in got[300]] == [3 * k for k in range(20)]


# ---- operator 12


@given(st.lists(st.integers(0, 7), max_size=300), st.integers(0, 7))
@settings(max_examples=60, deadline=None)
def test_wavelet_ranks(symbols, symbol):
    matrix = infill.WaveletMatrix(np.array(symbols, dtype=np.uint8), bits=3)
    want = [symbols[:p].count(symbol) for p in range(len(symbols) + 1)]
    assert matrix.rank(symbol, np.arange(len(symbols) + 1)).tolist() == want


@pytest.mark.parametrize("unit", sorted(infill.UNITS))
def test_cuts_at_units(unit):
    pattern = {"lines": r"[^\n]*\n|[^\n]+", "sentences": r"[^\n.!?]*[\n.!?]|[^\n.!?]+",
               "words": r"[^ \t\n]*[ \t\n]|[^ \t\n]+", "chars": r"(?s)."}[unit]
    texts = ["", "a", "\n", "\n\n", "one two.\nthree\tß 👍!\n\nfour", "x\n", "no end", "a. b? c! d", "tail \n y"]
    for seed in range(20):
        drawn = [infill.draws(k, seed) for k in range(len(texts))]
        units, first, second = infill.cut_texts(texts, drawn, unit)
        for k, text in enumerate(texts):
            n, a, b = brute.cuts(text, pattern, *drawn[k][:2])
            assert (n, a, b) == (units[k], first[k], second[k]), (text, seed)


def test_fill_in_middle_cases(spark):
    texts = [None, "", "plain <P> marker", "a\nb\nc\nd", "é\n👍 x\n" * 50, "<S", "\n" * 9, "x" * 300_000 + "\ny"]
    rows = [(k, t) for k, t in enumerate(texts * 6)] + [(None, "a\nb\nc")] * 2
    docs = spark.createDataFrame([(i, t, "en", "s", "n", "f", 1) for i, t in rows], DOCS)
    made = infill.fill_in_middle(docs)
    got = made.withColumn("again", infill.restored(F.col("form"), F.col("output"))).collect()
    want = [brute.infilled(i, t) for i, t in rows]
    assert sorted(map(str, (tuple(r)[:6] for r in got))) == sorted(map(str, want))
    texts_by_id = dict(rows)
    assert all(r["again"] == (texts_by_id[r["doc_id"]] or "") for r in got)
    assert infill.fill_in_middle(docs.where("false")).collect() == []
    assert {r["form"] for r in infill.fill_in_middle(docs, percent=0).collect()} == {"plain"}
    with pytest.raises(ValueError):
        infill.fill_in_middle(docs, unit="pages")


# ---- operator 13


def collocated(rows):
    return sorted(tuple(r) for r in rows)


def test_phrases_match_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        words = rng.choice(["New", "york", "city", "of", "the", "ß", "x\x0cy"], rng.integers(0, 40), p=[.2, .2, .1, .2, .1, .1, .1])
        text = "".join(w + rng.choice([" ", "  \t", ". ", ",", "\n"], p=[.6, .1, .1, .1, .1]) for w in words)
        if i % 4 == 0:
            text += " a long passage that is always the same here!" + " hot pair" + f" {i}" + " hot pair"
        rows.append((i, text if i % 11 else None, ["en", "de", None, "und"][i % 4], "s", "n", "f", 1))
    docs = spark.createDataFrame(rows, DOCS)
    for least, drop, top in ((3, 100, 2000), (5, 80, 7), (1, 100, None)):
        got = collocated(phrases.collocations(docs, least=least, drop_percent=drop, top=top).collect())
        assert got == collocated(brute.collocations([(r[2], r[1]) for r in rows], 5, least, drop, top))


def test_phrases_slices_and_longest(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 7)
    rows = [(i, "a b c a b d e f g a b c " * 9, "en", "s", "n", "f", 1) for i in range(5)]
    docs = spark.createDataFrame(rows, DOCS)
    for longest in (2, 3):
        got = collocated(phrases.collocations(docs, longest=longest, least=10).collect())
        assert got and got == collocated(brute.collocations([(r[2], r[1]) for r in rows], longest, 10, 100, None))
    assert phrases.collocations(docs.where("false")).collect() == []
    assert phrases.collocations(docs.withColumn("text", F.lit(" .,;\n"))).collect() == []


def test_phrases_exact_beyond_64_bits(spark, monkeypatch):
    """Counts whose products pass 64 bits."""
    big = 3 * 10**12
    rows = [("en", "", 0, 40 * big), ("en", "a", 1, 2 * big), ("en", "b", 1, big + 1), ("en", "a b", 2, big)]
    table = spark.createDataFrame(rows, "lang string, phrase string, k int, f long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *_: table)
    docs = spark.createDataFrame([], DOCS)
    row = phrases.collocations(docs).first()
    assert row["score"] == 1000 * big * 40 * big // (2 * big * (big + 1))
