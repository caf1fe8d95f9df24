"""Operators 1, 2, 3, 4, 8 and 9 against brute force, round trips and held-out accuracy."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import jaccard, packing, pii, quality, queries, repeats, toxicity
from quayside.llm import words as W
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string"
EDGE = [(10**6, None, None, None), (10**6 + 1, "", "en", "s"), (10**6 + 2, " \n\t ", "xx", None),
        (10**6 + 3, "one", None, None), (10**6 + 4, "é" * 300_000, "fr", None), (10**6 + 5, "long words " * 60_000, "en", None)]


@pytest.fixture(scope="module")
def docs(spark, small_dir):
    """The small documents with null, empty and very long ones, and a column of a clashing name."""
    return (spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
            .unionByName(spark.createDataFrame(EDGE, DOCS)).withColumn("row", F.lit(1)).cache())


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


# ---- words


def test_words_of_random_texts(monkeypatch):
    monkeypatch.setattr(W, "CHUNK_BYTES", 150)
    pick = random.Random(1)
    texts = ["".join(pick.choice(" \n\tabAé.\x0b") for _ in range(pick.randint(0, 30))) or None for _ in range(2000)]
    seen = {}
    for w in W.words(pa.array(texts, pa.string()), lower=True):
        for k in range(len(w)):
            a, b = w.first[k], w.first[k + 1]
            want = brute.words(texts[w.row + k])
            assert [bytes(w.data[x:y]).decode() for x, y in zip(w.start[a:b], w.end[a:b])] == want
            for word, h, cased in zip(want, w.hashes()[a:b], w.cased()[a:b]):
                assert seen.setdefault(word.translate(brute.LOWER), h) == h
                assert seen.setdefault(("cased", word), cased) == cased
    assert len(set(seen.values())) >= len({k for k in seen if isinstance(k, str)})


# ---- operator 1


def test_toxicity_is_learned_from_labels(spark):
    pick = random.Random(2)
    plain = ["river", "stone", "apple", "green", "walk", "table", "seven", "house"]
    bad = ["grimf", "blortak", "snarvel"]

    def text(toxic):
        w = [pick.choice(plain) + pick.choice("abcdefgh") for _ in range(pick.randint(30, 150))]
        if toxic:
            for _ in range(4):
                w[pick.randrange(len(w))] = pick.choice(bad) + pick.choice(["", "!", "###"])
        return " ".join(w)

    rows = [(i, text(i % 4 == 0), "en", "s", i % 4 == 0) for i in range(800)]
    docs = spark.createDataFrame([r[:4] for r in rows], DOCS)
    labels = spark.createDataFrame([(r[0], 1, int(r[4])) for r in rows] + [(1, 1, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(docs, labels, row=F.struct("doc_id", "text")).collect()
    wrong = [r for r in got if (r["score"] >= 0.5) != (r["row"]["doc_id"] % 4 == 0)]
    assert len(wrong) <= 8
    spans = [(r["row"]["text"][s["start"]:s["end"]]) for r in got for s in r["spans"]]
    assert len(spans) > 500 and sum(any(b in s for b in bad) for s in spans) > 0.98 * len(spans)
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and abs(left.count() - 600) <= 8


def test_toxicity_whole_table(spark, small_dir, docs):
    out = queries.QUERIES["op1_crf_toxicity"](spark, small_dir)
    assert out.count() == spark.read.parquet(f"{small_dir}/documents.parquet").count()
    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.score_toxicity(docs, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.score_toxicity(docs.where("false"), labels).collect() == []


def test_forward_backward_against_enumeration():
    from itertools import product
    score, moves = np.array([[0.3, -1.0, 2.0, 0.5]]), np.array([[0.2, -0.4], [0.1, 0.7]])
    for length in (1, 2, 3, 4):
        weight = {}
        for tags in product((0, 1), repeat=length):
            s = sum(score[0, t] for t in range(length) if tags[t]) + sum(moves[a, b] for a, b in zip(tags, tags[1:]))
            weight[tags] = np.exp(s)
        total = sum(weight.values())
        want = [sum(w for tags, w in weight.items() if tags[t]) / total for t in range(length)]
        got, moved = toxicity.forward_backward(score, np.array([length]), moves)
        assert np.allclose(got[0, :length], want) and np.allclose(moved.sum(), length - 1)


def test_toxicity_marginals_do_not_depend_on_stretches():
    """Documents of several stretches against one chain each; plain stretches too."""
    rng = np.random.default_rng(6)
    sizes = [0, 1, 63, 64, 65, 128, 400, 700, 0]
    first = np.concatenate([[0], np.cumsum(sizes)])
    forms = rng.integers(1, 10**6, (first[-1], 5)).astype(np.uint64) * np.uint64(2)
    keys = np.arange(1, 40, 2, dtype=np.uint64)
    marked = rng.random(first[-1]) < np.where((np.arange(first[-1]) // 150) % 2, 0.2, 0.0)
    forms[marked, 0] = rng.choice(keys, marked.sum())
    moves = np.array([[0.5, -1.0], [-0.7, 0.9]])
    model = toxicity.Chain(keys, rng.normal(2, 1, len(keys)), -2.0, moves)
    got = toxicity.token_marginals(model, forms, first)
    score, _ = model.emissions(forms)
    for a, b in zip(first, first[1:]):
        if b > a:
            want, _ = toxicity.forward_backward(score[None, a:b], np.array([b - a]), moves)
            assert np.allclose(got[a:b], want[0])


def test_toxicity_training_rows_are_bounded(spark):
    """One text an id, whatever often it comes; bytes a class."""
    made = [(1, f"text {k}", None, None) for k in range(500)] + [(k, "x" * 100, None, None) for k in range(2, 40)]
    docs = spark.createDataFrame(made, DOCS)
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(40)] * 2, "doc_id long, quality int, toxic int")
    rows = toxicity.training_rows(docs, labels, total_bytes=500)
    assert sum(t.startswith("text") for t, _ in rows) <= 1
    for y in (0, 1):
        assert 300 <= sum(len(t) for t, label in rows if label == y) <= 500
    assert rows == toxicity.training_rows(docs, labels, total_bytes=500)


# ---- operator 2


def test_quality_base_counts(docs, rows):
    got = {r["doc_id"]: tuple(r)[1:7] for r in quality.judge_quality(docs).collect()}
    assert got == {i: brute.base_quality(t) for i, t in rows}


def test_quality_verdict_follows_labels(spark, small_dir):
    sf = small_dir.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.QUERIES["op2_distribution_divergence"](spark, sf).join(labels, "doc_id").collect()
    judged = [r for r in got if not r["base_failed"]]
    good = [r["kept"] for r in judged if r["quality"] == 1]
    assert sum(good) >= 0.99 * len(good)
    bad = [r["kept"] for r in judged if r["quality"] == 0]
    assert sum(bad) <= 0.1 * len(bad)


def test_quality_empty_and_unknown_language(spark):
    docs = spark.createDataFrame([(1, None, None, None), (2, "a b c " * 40, "zz", None)], DOCS)
    assert {r["doc_id"]: r["kept"] for r in quality.judge_quality(docs).collect()} == {1: False, 2: False}
    assert quality.judge_quality(docs.where("false")).collect() == []


def test_quality_references_beyond_the_broadcast_ones(docs):
    """The bound of the broadcast changes no row."""
    want = sorted(map(tuple, quality.judge_quality(docs).collect()))
    for most in (0, 2):
        got = sorted(map(tuple, quality.judge_quality(docs, broadcast_languages=most).collect()))
        assert [r[:8] for r in got] == [r[:8] for r in want]
        assert np.allclose([r[8:] for r in got], [r[8:] for r in want], atol=1e-9)


def test_quality_rare_language_is_not_its_own_reference(docs):
    broken = " ".join(f"#{k}% |{k * 7}$" for k in range(300))
    table = docs.drop("row").unionByName(docs.sparkSession.createDataFrame([(2 * 10**6, broken, "qq", None)], DOCS))
    row = quality.judge_quality(table).where("doc_id = 2000000").first()
    assert not row["base_failed"] and not row["kept"]


@pytest.mark.parametrize("copies", [1, 40])
def test_quality_text_and_copies_are_left_out_of_the_reference(docs, copies):
    """Long junk that is, with its copies, nearly all of its language is not judged by itself."""
    broken = " ".join(f"#{k}% |{k * 7}$" for k in range(2000))
    made = [(2 * 10**6 + k, broken, "qq", None) for k in range(copies)]
    made += [(3 * 10**6 + k, f"kurz {k} und gut", "qq", None) for k in range(30)]
    judged = quality.judge_quality(docs.drop("row").unionByName(docs.sparkSession.createDataFrame(made, DOCS)))
    got = judged.where("doc_id BETWEEN 2000000 AND 2999999").collect()
    assert len(got) == copies and not any(r["base_failed"] or r["kept"] for r in got)


def test_quality_distances_match_brute_force(spark):
    """Distances against Python loops: the language or the pooled counts, without the text and its copies."""
    rng = np.random.default_rng(5)
    made = []
    for k in range(60):
        vocabulary = [f"{'ab'[k % 2]}w{j}" for j in range(30)]
        made.append((k, " ".join(rng.choice(vocabulary, 60 + k)), ["xx", "yy", None][k % 3], None))
    made += [(100 + k, made[0][1], "xx", None) for k in range(3)]
    got = {r["doc_id"]: r for r in quality.judge_quality(spark.createDataFrame(made, DOCS), min_reference_words=500,
                                                         min_reference_texts=5).collect()}
    for i, text, lang, _ in made:
        for column, split in (("char_distance", brute.char_classes), ("word_distance", brute.words)):
            want = brute.reference_distance(text, [t for _, t, x, _ in made if lang is None or x == lang], split,
                                            None if column == "char_distance" else quality.COMMON_WORDS)
            assert got[i][column] == pytest.approx(want, abs=1e-9), (i, column)


# ---- operator 3


def test_packing_round_trip(spark, small_dir, docs, rows):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces = packing.pack_documents(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    texts = dict(rows)
    of, sequences = {}, {}
    for p in pieces:
        of.setdefault(p["doc_id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append(p)
    assert set(of) == set(texts)
    for i, held in of.items():
        held.sort(key=lambda p: p["start"])
        got = np.frombuffer(b"".join(bytes(p["ids"]) for p in held), dtype="<u4")
        want = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [1]
        assert got.tolist() == want and {p["doc_tokens"] for p in held} == {len(want)}
        assert [p["start"] for p in held] == np.cumsum([0] + [p["length"] for p in held])[:-1].tolist()
    for held in sequences.values():
        held.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in held] == np.cumsum([0] + [p["length"] for p in held])[:-1].tolist()
        assert sum(p["length"] for p in held) <= packing.SEQUENCE
    short = [k for k, v in sequences.items() if sum(p["length"] for p in v) < packing.SEQUENCE]
    assert len(short) <= docs.rdd.getNumPartitions()


def test_packing_long_white_space(spark):
    """Runs of white space that the fast library's pattern cannot take."""
    import public_tokenizers as P
    from tokenizers import Tokenizer
    contract = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = [" " * 2_000_000, "\n" * 2_000_000, "a" + "\t" * 60_000 + "b <|endoftext|> c"]
    docs = spark.createDataFrame([(k, t, None, None) for k, t in enumerate(texts)], DOCS)
    held = {}
    for p in packing.pack_documents(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect():
        held.setdefault(p["doc_id"], []).append((p["start"], bytes(p["ids"])))
    for k, text in enumerate(texts):
        ids = np.frombuffer(b"".join(b for _, b in sorted(held[k])), dtype="<u4")
        assert ids.tolist() == contract.encode(text, add_special_tokens=False).ids + [packing.END_ID]


def test_packing_finds_added_tokens(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"one  {end}  two\n\n{end}\n", f"it{end}'s <|endoftext| >", f"x{end[:-1]}", f"é{end}٣ " * 900]
    pick = random.Random(8)
    texts += ["".join(pick.choice([end, end[:5], " ", "\n", "a", "'s", "<|", "12", "é"]) for _ in range(30)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], DOCS)
    got = {}
    for p in packing.pack_documents(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect():
        got.setdefault(p["doc_id"], []).append((p["start"], bytes(p["ids"]), p["doc_tokens"]))
    for i, text in enumerate(texts):
        want = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        ids = np.frombuffer(b"".join(b for _, b, _ in sorted(got[i])), dtype="<u4")
        assert ids.tolist() == want and {n for *_, n in got[i]} == {len(want)}


def test_sum_of_squares_choice():
    """Each placement is the one that leaves the smallest sum of squared level counts."""
    pick = random.Random(3)
    size = 32
    levels = packing.Levels(size, 10**6, lambda held: None)
    for _ in range(400):
        length = pick.randint(1, size - 1)
        before = levels.counts.copy()

        def after(level):
            c = before.copy()
            if level:
                c[level] -= 1
            if level + length < size:
                c[level + length] += 1
            return int((c * c).sum())

        choices = [h for h in range(size - length + 1) if h == 0 or before[h]]
        levels.add(((0, 0)), length)
        assert int((levels.counts ** 2).sum()) == min(after(h) for h in choices)


def test_packing_flushes_when_many_are_open():
    out = []
    levels = packing.Levels(100, 5, out.append)
    for k in range(40):
        levels.add((k, 0), 60)
    levels.flush()
    filled = [sum(n for _, n in held) for held in out]
    assert sum(filled) == 2400 and sum(f < 100 for f in filled) <= 9


# ---- operator 4


@pytest.mark.parametrize("heavy", [0, 3, 4096])
def test_repeats_against_brute_force(monkeypatch, docs, rows, heavy):
    for name, value in (("CHUNK_BYTES", 150_000), ("GROUP_BYTES", 100_000), ("BLOCK_BYTES", 100_000)):
        monkeypatch.setattr(repeats, name, value)
    passage = " ".join(f"shared{k}" for k in range(30))
    extra = [(2 * 10**6 + i, f"own{i} words{i} before {passage} after{i} words", None, None) for i in range(80)]
    extra += [(3 * 10**6 + i, "a b " * 50, None, None) for i in range(4)]
    spark = docs.sparkSession
    table = docs.drop("row").unionByName(spark.createDataFrame(extra, DOCS))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["text"]) for r in repeats.remove_repeats(table, heavy=heavy).collect()}
    assert got == brute.without_repeats(rows + [e[:2] for e in extra])


def test_repeats_spans_ties_and_empty(spark):
    run = " ".join("abcdefghijklmn")
    docs = spark.createDataFrame([(1, run, None, None), (2, "x " + run, None, None), (2, "x " + run, None, None),
                                  (None, run, None, None)], DOCS)
    got = sorted(((r["doc_id"], r["n_removed"], [tuple(s) for s in r["removed"]])
                  for r in repeats.remove_repeats(docs).collect()), key=str)
    assert got == sorted([(1, 0, []), (2, 14, [(1, 14)]), (2, 14, [(1, 14)]), (None, 14, [(0, 14)])], key=str)
    assert repeats.remove_repeats(docs.where("false")).collect() == []


def test_suffix_tree_depths():
    suffixes = np.array([[1, 2, 3], [1, 2, 4], [1, 2, 3], [2, 0, 0]], dtype=np.uint32)
    order, common = repeats.suffix_tree(suffixes)
    assert suffixes[order].tolist() == [[1, 2, 3], [1, 2, 3], [1, 2, 4], [2, 0, 0]] and common.tolist() == [0, 3, 2, 0]


# ---- operator 8


def test_base_spans_of_random_texts():
    pick = random.Random(4)
    parts = ["1", "25", "300", ".", ".", "@", "a", "b.", "-", "+", " ", "(", "4111111111111111", "é", "٣", "0001"]
    for _ in range(20_000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 14)))
        assert pii.base_spans(text) == brute.personal_data(text), text


def test_personal_data_query(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_weak_supervision_pii"](spark, small_dir).collect()}
    for r in docs.collect():
        base = brute.personal_data(r["text"])
        out = got[r["doc_id"]]
        assert [out[f"n_{k}"] for k in pii.KINDS] == [len(base[k]) for k in pii.KINDS]
        listed = [f"{k}:{a}:{b}" for k in pii.KINDS for a, b in base[k]]
        assert out["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(out["spans"].split(",")) | {""}


def test_method_adds_what_the_patterns_lose(spark):
    known = [(i, f"word mail me a{i}@mail.example.com or +1 (2{i % 10}4) 555-01{i % 90 + 10} now", None, None) for i in range(200)]
    lost = (900, "call +1 (269) 555-3296 4111111111111111 today", None, None)
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in
           pii.find_personal_data(spark.createDataFrame([*known, lost, (901, None, None, None)], DOCS)).collect()}
    assert (3, 5, 22) in got[900] and got[901] == []
    assert all(len(got[i]) == 2 for i in range(200))


@pytest.mark.parametrize("span", ["John [At] corp.com", "john at example dot com", "JOHN AT mail DOT example DOT org",
                                  "john @ example . com", "john @ example.com", "john (at) corp [dot] com"])
def test_spelt_and_spaced_addresses_are_candidates(span):
    text = f"écrire: {span}, thx"
    found = [(text[a:b], base) for kind, a, b, base, _ in pii.candidates(text) if kind == 0]
    assert found == [(span, False)]
    for plain in ("meet @ home. Then go", "we met at noon", "one @ two", "a polka dot dress at home"):
        assert pii.candidates(plain) == []


# ---- operator 9


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_similar_groups_against_brute_force(docs, rows, size, percent):
    pick = random.Random(5)
    base = [f"w{pick.randrange(5000)}" for _ in range(160)]
    extra = []
    for i in range(60):
        copy = list(base)
        for _ in range(i % 7):
            copy[pick.randrange(len(copy))] = f"new{pick.randrange(10**6)}"
        extra.append((2 * 10**6 + i, " ".join(copy), None, None))
    table = docs.drop("row").unionByName(docs.sparkSession.createDataFrame(extra, DOCS))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_groups(table, size, percent).collect()}
    assert got == brute.similar_groups(rows + [e[:2] for e in extra], size, percent)


def test_similar_groups_cases(spark):
    docs = spark.createDataFrame([(4, "A b c", None, None), (3, "a B c", None, None), (9, None, None, None),
                                  (2, "", None, None), (None, "x y z", None, None), (4, "a b c", None, None)], DOCS)
    got = sorted((tuple(r) for r in jaccard.similar_groups(docs).collect()), key=str)
    assert got == sorted([(4, 1, 3), (3, 1, 3), (4, 1, 3), (9, 0, 9), (2, 0, 2), (None, 1, None)], key=str)
    assert jaccard.similar_groups(docs.where("false")).collect() == []
    kept = jaccard.keep_one_of_each(docs.withColumn("row", F.lit("x")))
    assert kept.columns == [*docs.columns, "row"]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 3, 9, None]


def test_keep_one_of_each_with_repeated_and_null_ids(spark):
    base = [f"w{k}" for k in range(100)]
    near = " ".join(base[:-1] + ["other"])
    other, lone = " ".join(f"x{k}" for k in range(60)), " ".join(f"y{k}" for k in range(60))
    rows = [(3, " ".join(base), "en", "s"), (5, near, "en", "s"), (5, "a clean text of its own words", "en", "s"),
            (3, near, "en", "s"), (None, near + " end", "en", "s"), (None, other, "en", "s"), (None, other + " end", "en", "s"),
            (7, lone, "en", "s"), (7, lone, "fr", "t"), (8, None, None, None), (8, None, None, None), (8, "", None, None)]
    got = [(r["doc_id"], r["text"]) for r in jaccard.keep_one_of_each(spark.createDataFrame(rows, DOCS)).collect()]
    of_three = min(rows[0][1], near, key=lambda t: hashlib.md5(t.encode()).digest())
    of_none = min(other, other + " end", key=lambda t: hashlib.md5(t.encode()).digest())
    assert sorted(got, key=str) == sorted([(3, of_three), (5, rows[2][1]), (None, of_none), (7, lone), (8, None), (8, None),
                                           (8, "")], key=str)


def test_components_of_a_long_path(spark):
    from quayside.llm.common import Stager
    from quayside.llm.components import components
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(5, 7), (9, 7), (1, 1)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(Stager(spark), links).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, 7: 5, 9: 5}


# ---- whole texts


def test_queries_cover_every_document(spark, small_dir):
    n = spark.read.parquet(f"{small_dir}/documents.parquet").count()
    for name in ("op4_suffix_tree_dedup", "op9_jaccard_join"):
        assert queries.QUERIES[name](spark, small_dir).count() == n
    assert re.match("op", name)
