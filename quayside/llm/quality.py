"""Quality rules (operator 2): distribution divergence from language references.

References: over all documents of a language, the share of each character
class, and of each of its ``COMMON_WORDS`` most frequent words (one more bin
takes the rest). Counts are summed per partition before the shuffle; word
hashes travel, not words. A text's own two histograms are compared with its
language's by Jensen-Shannon distance (square root of the divergence in bits,
0 to 1). A distance is judged only on texts long enough for it to mean
something, ``MIN_CHARS`` characters or ``MIN_WORDS`` words, and the distance
allowed falls with the root of the length, as sampling noise does.

No text is judged by itself. Before a comparison the text's own counts, those
of all its exact copies included, are taken out of the reference. A language
has a reference of its own if it has ``MIN_REFERENCE_TEXTS`` different texts and
if ``MIN_REFERENCE_WORDS`` words are left without the text; else the text is
compared with the pooled reference of all documents, also without it. If that
has too few words left too, nothing is known to compare with and no distance is
judged. The references of the ``BROADCAST_LANGUAGES`` languages with the most
words are broadcast, a fixed bound; documents of the others are joined with
theirs by language, so results do not depend on it.

Cases: a null or empty text has no words, so its base rule fails and no
distance is judged. Rows that repeat an id are judged one by one. Of equally frequent words the smaller
hash comes first. An empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import Stager, ship_package, text_of
from quayside.llm.exact import content_hash
from quayside.llm.words import Words, grams, mix, within, words

COMMON_WORDS = 100
MIN_CHARS = 200
MIN_WORDS = 50
# A distance may be up to a + b / sqrt(length): a short text's histogram is noisy.
CHAR_BOUND = (0.14, 3.0)
WORD_BOUND = (0.26, 1.7)
MIN_REFERENCE_TEXTS = 20
MIN_REFERENCE_WORDS = 2000
BROADCAST_LANGUAGES = 4096
MIN_BASE_WORDS = 50       # base rule of the contract
MAX_BASE_REPEATED = 0.5   # base rule of the contract

CLASSES = ("lower", "upper", "digit", "space", "line", "sentence", "symbol", "ascii", "latin", "script", "wide")
_CLASS_OF = np.full(256, CLASSES.index("ascii"), dtype=np.int64)
for _name, _bytes in (("lower", range(0x61, 0x7B)), ("upper", range(0x41, 0x5B)), ("digit", range(0x30, 0x3A)),
                      ("space", [0x20, 0x09]), ("line", range(0x0A, 0x0E)), ("sentence", b".,;:!?'\"()-"),
                      ("symbol", b"#*$%&|<>"), ("latin", range(0xC2, 0xC6)), ("script", range(0xC6, 0xE0)),
                      ("wide", range(0xE0, 0x100))):
    _CLASS_OF[list(_bytes)] = CLASSES.index(_name)
_CLASS_OF[0x80:0xC0] = len(CLASSES)  # later bytes of a character: no class
_SYMBOL = _CLASS_OF == CLASSES.index("symbol")
_WIDTH = len(CLASSES) + 1
_SEEN = pa.schema([("lang", pa.string()), ("kind", pa.string()), ("key", pa.int64()), ("n", pa.int64())])


def class_counts(w: Words) -> np.ndarray:
    """Characters per text and class."""
    text = np.repeat(np.arange(len(w)), np.diff(w.offset))
    return np.bincount(text * _WIDTH + _CLASS_OF[w.data], minlength=len(w) * _WIDTH).reshape(-1, _WIDTH)[:, :-1]


def _count_histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and language: characters per class ('c'), occurrences per word hash ('w')."""
    for batch in batches:
        langs = np.array([x or "" for x in batch.column(0).to_pylist()], dtype=object)
        names, code = np.unique(langs.astype(str), return_inverse=True) if len(langs) else ([], langs)
        chars = np.zeros((len(names), len(CLASSES)), dtype=np.int64)
        seen: list[list] = [[] for _ in names]
        for w in words(batch.column(1), lower=True):
            own = code[w.row:w.row + len(w)]
            np.add.at(chars, own, class_counts(w))
            hashes, of_word = w.hashes(), own[w.text_of_word()]
            for k in np.unique(own):
                seen[k].append(hashes[of_word == k])
        for k, name in enumerate(names):
            key, n = np.unique(np.concatenate(seen[k]), return_counts=True)
            for kind, keys, counts in (("c", np.arange(len(CLASSES)), chars[k]), ("w", key.view(np.int64), n)):
                yield pa.record_batch([pa.array([str(name)] * len(keys), pa.string()),
                                       pa.array([kind] * len(keys), pa.string()),
                                       pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], schema=_SEEN)


class Reference:
    """Counts of character classes, and of common words and the rest, of a language."""

    def __init__(self, rows: list[tuple]):
        chars = np.zeros(len(CLASSES))
        common, total = [], 0
        for kind, key, n, of in rows:
            if kind == "c":
                chars[key] = n
            else:
                common.append((np.uint64(key % 2**64), n))
                total = of
        self.chars = chars
        common.sort()
        self.keys = np.array([k for k, _ in common], dtype=np.uint64)
        counts = np.array([n for _, n in common], dtype=float)
        self.words = np.append(counts, total - counts.sum())

    def word_counts(self, hashes: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
        """Occurrences per text of each common word, and of the rest."""
        bins = len(self.keys) + 1
        at = np.searchsorted(self.keys, hashes)
        at[np.take(self.keys, at, mode="clip") != hashes] = bins - 1 if len(self.keys) else 0
        return np.bincount(text * bins + at, minlength=n_texts * bins).reshape(n_texts, bins)


def reference_of(bins) -> Reference:
    return Reference([(b["kind"], b["key"], b["n"], b["of"]) for b in bins])


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row's distribution from the reference counts beside it."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    shares = reference / np.maximum(reference.sum(axis=1, keepdims=True), 1)
    m = (p + shares) / 2

    def half(a):
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1) / 2

    return np.sqrt(np.maximum(half(p) + half(shares), 0))


POOLED = ""  # the language of the pooled reference; counts of a null language have the same name


def references(docs: DataFrame, common_words: int = COMMON_WORDS, min_reference_words: int = MIN_REFERENCE_WORDS,
               min_reference_texts: int = MIN_REFERENCE_TEXTS) -> tuple[DataFrame, DataFrame]:
    """One row per reference: lang (``POOLED`` for the pooled one), n_words and its bins; and one per text that
    several rows have and language: lang, digest, copies in the language and in all."""
    ship_package(docs.sparkSession)
    stage = Stager(docs.sparkSession)
    texts = stage(docs.select(F.coalesce(docs["lang"].cast("string"), F.lit(POOLED)).alias("lang"),
                              content_hash(text_of(docs)).alias("digest"))
                  .groupBy("lang", "digest").agg(F.count(F.lit(1)).alias("copies")), "texts")
    several = texts.groupBy("digest").agg(F.sum("copies").alias("all_copies")).where("all_copies > 1")
    copies = stage(texts.join(several.hint("merge"), "digest"), "copies")
    named = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("texts")).where(
        (F.col("texts") >= min_reference_texts) | (F.col("lang") == POOLED)).select("lang")
    rows = docs.select(docs["lang"].cast("string").alias("lang"), text_of(docs).alias("text"))
    counts = stage(rows.mapInArrow(_count_histograms, "lang string, kind string, key long, n long")
                   .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "counts")
    pooled = counts.groupBy("kind", "key").agg(F.sum("n").alias("n")).select(
        F.lit(POOLED).alias("lang"), "kind", "key", "n")
    kept = counts.where(F.col("lang") != POOLED).unionByName(pooled)
    group = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    total = stage(kept.groupBy("lang", "kind").agg(F.sum("n").alias("of")), "totals")
    every = named.unionByName(docs.sparkSession.createDataFrame([(POOLED,)], "lang string")).distinct()
    large = (total.where("kind = 'w'").where((F.col("of") >= min_reference_words) | (F.col("lang") == POOLED))
             .join(every.hint("merge"), "lang", "left_semi"))
    common = kept.withColumn("place", F.row_number().over(group)).where(F.col("place") <= common_words).drop("place")
    # At most ``common_words`` and one bin per class a language.
    bins = (common.join(total.hint("merge"), ["lang", "kind"]).groupBy("lang")
            .agg(F.collect_list(F.struct("kind", "key", "n", "of")).alias("bins")))
    return (stage(large.select("lang", F.col("of").alias("n_words")).join(bins.hint("merge"), "lang"), "references"),
            copies)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars")
_MEASURED = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("digest", pa.binary()),
                       *((name, pa.int64()) for name in _COUNTS),
                       *((name, pa.list_(pa.int32())) for name in ("chars", "own", "pooled"))])
MEASURED = "doc_id long, lang string, digest binary, " + ", ".join(f"{name} long" for name in _COUNTS) + \
           ", chars array<int>, own array<int>, pooled array<int>"
_JUDGED = pa.schema([("doc_id", pa.int64()), *((name, pa.int64()) for name in _COUNTS),
                     ("char_distance", pa.float64()), ("word_distance", pa.float64())])
JUDGED = "doc_id long, " + ", ".join(f"{name} long" for name in _COUNTS) + ", char_distance double, word_distance double"


def _per_text(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[ends])


def repeated_words(w: Words, hashes: np.ndarray, size: int = 3) -> np.ndarray:
    """Words per text that lie in a window of ``size`` words found twice or more in the text."""
    covered = np.zeros(len(hashes), dtype=bool)
    at = np.flatnonzero(within(w.first, size))
    if len(at):
        key = mix(grams(hashes, size)[at] + w.text_of_word()[at].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(at), dtype=bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        for k in range(size):
            covered[at[again] + k] = True
    return _per_text(covered, w.first)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    held = [line for line in text.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    return len(held) - len(set(held))


def _found(common: dict[str, Reference], langs: list, batch: pa.RecordBatch) -> dict[str, Reference]:
    """The broadcast references, and those that a last column of bins brings."""
    if batch.schema.names[-1] != "bins":
        return common
    bins = batch.column("bins")
    at = {lang: k for k, lang in enumerate(langs) if bins[k].is_valid}
    return common | {lang: reference_of(bins[k].as_py()) for lang, k in at.items()}


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel().astype(np.int32)))


def _measure(common: dict[str, Reference]):
    """Per text: the base counts, and its histograms over the bins of its language and of the pooled reference."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            found = _found(common, langs, batch)
            for w in words(batch.column("text"), lower=True):
                n = len(w)
                word_of = w.text_of_word()
                starts = (w.data & 0xC0) != 0x80
                inside = np.zeros(len(w.data) + 1, dtype=np.int64)
                np.add.at(inside, w.start, 1)
                np.add.at(inside, w.end, -1)
                in_word = np.cumsum(inside[:-1]) > 0
                cased, lowered = w.cased(), w.hashes()
                here = langs[w.row:w.row + n]
                own: list = [[]] * n
                for lang in set(here) & set(found):
                    rows = np.array([x == lang for x in here])
                    place = np.cumsum(rows) - 1
                    mine = rows[word_of]
                    counts = found[lang].word_counts(lowered[mine], place[word_of[mine]], int(rows.sum()))
                    for k, row in zip(np.flatnonzero(rows), counts.astype(np.int32)):
                        own[k] = row
                pooled = (found[POOLED].word_counts(lowered, word_of, n) if POOLED in found
                          else np.zeros((n, 1), dtype=np.int64))
                columns = [
                    np.diff(w.first), _per_text(in_word & starts, w.offset), _per_text(_SYMBOL[w.data], w.offset),
                    np.array([repeated_lines(w.data[a:b].tobytes()) for a, b in zip(w.offset, w.offset[1:])]),
                    repeated_words(w, cased), _per_text(starts, w.offset)]
                part = batch.slice(w.row, n)
                out = pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("lang"), part.column("digest"),
                     *(pa.array(c, pa.int64()) for c in columns), _lists(class_counts(w)),
                     pa.array(own, pa.list_(pa.int32())), _lists(pooled)], schema=_MEASURED)
                if batch.schema.names[-1] == "bins":
                    out = out.append_column("bins", part.column("bins"))
                yield out
    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float) if len(column) else (
        np.zeros((0, 1)))


def _compare(common: dict[str, Reference], min_words: int):
    """Distances of each text from its reference without the text and its copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            found = _found(common, langs, batch)
            n = batch.num_rows
            chars, n_words = _matrix(batch.column("chars")), batch.column("n_words").to_numpy()
            copies = {name: batch.column(name).to_numpy() for name in ("copies", "all_copies")}
            char_d, word_d = np.zeros(n), np.zeros(n)
            open_ = np.ones(n, dtype=bool)

            def compare(rows, ref, counts, times):
                left = ref.words.sum() - times * n_words[rows] >= min_words
                rows, counts, times = rows[left], counts[left], times[left, None]
                char_d[rows] = distance(chars[rows], np.maximum(ref.chars - times * chars[rows], 0))
                word_d[rows] = distance(counts, np.maximum(ref.words - times * counts, 0))
                open_[rows] = False

            for lang in set(langs) & set(found):
                if lang != POOLED:
                    rows = np.flatnonzero([x == lang for x in langs])
                    compare(rows, found[lang], _matrix(batch.column("own").take(pa.array(rows))), copies["copies"][rows])
            if POOLED in found:
                rows = np.flatnonzero(open_)
                compare(rows, found[POOLED], _matrix(batch.column("pooled").take(pa.array(rows))),
                        copies["all_copies"][rows])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(name) for name in _COUNTS), pa.array(char_d), pa.array(word_d)],
                schema=_JUDGED)
    return run


def judge_quality(docs: DataFrame, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS,
                  char_bound: tuple[float, float] = CHAR_BOUND,
                  word_bound: tuple[float, float] = WORD_BOUND, min_reference_words: int = MIN_REFERENCE_WORDS,
                  broadcast_languages: int = BROADCAST_LANGUAGES,
                  min_reference_texts: int = MIN_REFERENCE_TEXTS) -> DataFrame:
    """One row per document: the base counts, base_failed, both distances and kept."""
    refs, copies = references(docs, min_reference_words=min_reference_words, min_reference_texts=min_reference_texts)
    own = refs.where(F.col("lang") != POOLED)
    largest = own.orderBy(F.desc("n_words"), "lang").limit(broadcast_languages).collect()
    broadcast = {r["lang"]: reference_of(r["bins"]) for r in refs.where(F.col("lang") == POOLED).collect() + largest}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(docs["lang"].cast("string"), F.lit(POOLED)).alias("lang"), text_of(docs).alias("text"),
                       content_hash(text_of(docs)).alias("digest"))

    def judge(rows: DataFrame, more: str = "") -> DataFrame:
        measured = rows.mapInArrow(_measure(broadcast), MEASURED + more)
        together = measured.join(copies.hint("merge"), ["lang", "digest"], "left")
        one = [F.coalesce(c, F.lit(1)).cast("long").alias(c) for c in ("copies", "all_copies")]
        kept = [c for c in measured.columns if c not in ("digest", "bins")]
        return together.select(*kept, *one, *(["bins"] if more else [])).mapInArrow(
            _compare(broadcast, min_reference_words), JUDGED)

    if len(largest) < broadcast_languages:
        judged = judge(rows)
    else:
        # Languages beyond the broadcast ones: a language's documents meet its one row of bins.
        here = F.col("lang").isin(list(broadcast))
        bins = own.where(~here).select("lang", "bins")
        judged = judge(rows.where(here)).unionByName(
            judge(rows.where(~here).join(bins.hint("merge"), "lang", "left"), f", bins {bins.schema['bins'].dataType.simpleString()}"))
    base = (F.col("n_words") < MIN_BASE_WORDS) | (F.col("n_repeat_words") > MAX_BASE_REPEATED * F.col("n_words"))

    def far(of: str, length: str, least: int, bound: tuple[float, float]):
        allowed = bound[0] + bound[1] / F.sqrt(F.greatest(F.col(length), F.lit(1)))
        return (F.col(length) >= least) & (F.col(of) > allowed)

    strange = (far("char_distance", "n_chars", min_chars, char_bound)
               | far("word_distance", "n_words", min_words, word_bound))
    return (judged.withColumn("base_failed", base).withColumn("kept", ~base & ~strange)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "kept", "char_distance", "word_distance"))
