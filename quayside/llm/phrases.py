"""Phrase collocation mining (operator 13): a weighted de Bruijn graph of word runs, per language.

1. Texts are cut into pieces and words. Occurrences of neighbouring pairs are
   summed by hash into ``PAIR_SLOTS`` counters. A pair whose counter stays below
   ``least`` is rarer than that, and so is every phrase that holds it; such a
   pair ends a piece below. The counters only save work: a pair that shares
   one with others is kept although it is rare, and no count comes from them.
2. Each word occurrence becomes one edge: the window of ``longest`` words that
   it starts, from the node of its first words to the node of its last. Near
   the end of a piece the window is shorter: these are the piece-end
   corrections. Equal windows are summed (partial sums before the shuffle).
3. Shorter counts follow from the flow: what leaves a node of k words is the
   sum of the edges that start with it and of the piece ends in it. Summed
   edges are passed on to the nodes they start with, down to the empty node,
   whose flow is ``n``. Partial sums keep a word or a word pair that a third of
   all windows start with to one row a task.
4. Unary paths are compacted: a candidate whose flow goes on along a single
   edge, or comes in by a single edge (``drop_percent`` of it), goes into that
   longer phrase. A phrase is inside a longer one of its count only if it is
   inside one that is longer by a word, since counts never rise with length.
5. The others are cut at each place and scored in exact decimals.

Cases: a null text counts as empty, a null language as ``und``. Texts without
words add nothing. Rows that repeat an id all count. An empty table gives an
empty result. Other columns of the input are not read. A task holds a chunk of
about a megabyte of text (at least one text) and a slice of ``SLICE`` windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import Stager, ship_package, text_of
from quayside.llm.words import U64, Words, mix, words

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
PAIR_SLOTS = 1 << 27   # counters of pairs; which reach ``least`` is a bitmap of 16 MB, on the driver and each executor
SLICE = 1 << 17
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(PIECE_ENDS)] = True


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The slices of ``data`` as a string array."""
    length = end - start
    offset = np.zeros(len(length) + 1, dtype=np.int64)
    np.cumsum(length, out=offset[1:])
    place = np.arange(offset[-1]) + np.repeat(start - offset[:-1], length)
    return pa.StringArray.from_buffers(len(length), pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(data[place]))


def _langs(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct languages, the number of each row's, and a hash of each."""
    coded = column.dictionary_encode()
    names = coded.dictionary
    seeds = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names.to_pylist()]
    return names, coded.indices.to_numpy(), np.array(seeds, dtype=U64)


def _pair_slots(w: Words, code: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The counter of each word and the next one; -1 where the next word is of another piece or text."""
    if not len(w.start):
        return np.zeros(0, dtype=np.int64)
    text = w.text_of_word()
    hashes = w.hashes()
    piece = np.concatenate([[0], np.cumsum(_ENDS[w.data])])[w.start] + text
    slot = mix(hashes[:-1] * U64(0x9E3779B97F4A7C15) + hashes[1:] ^ seeds[code[w.row + text[1:]]]) % U64(PAIR_SLOTS)
    return np.append(np.where(piece[1:] == piece[:-1], slot.astype(np.int64), -1), -1)


def _count_pairs(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, code, seeds = _langs(batch.column(0))
        for w in words(batch.column(1), lower=True, breaks=PIECE_ENDS):
            slot = _pair_slots(w, code, seeds)
            found, n = np.unique(slot[slot >= 0].astype(np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n, type=pa.int64())], names=["slot", "f"])


def _windows(batches, frequent: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, code, seeds = _langs(batch.column(0))
        for w in words(batch.column(1), lower=True, breaks=PIECE_ENDS):
            n = len(w.start)
            if not n:
                continue
            lang = code[w.row + w.text_of_word()]
            slot = _pair_slots(w, code, seeds)
            goes_on = (slot >= 0) & ((frequent[slot >> 6] >> (slot & 63).astype(U64) & U64(1)) == 1)
            stop = np.flatnonzero(~goes_on)
            run_end = stop[np.searchsorted(stop, np.arange(n))]
            # The words, a space after each: every window is a slice.
            size = w.end - w.start
            to = np.cumsum(size + 1)
            begin = to - size - 1
            place = np.arange(to[-1]) + np.repeat(w.start - begin, size + 1)
            joined = _LOWER[w.data[np.minimum(place, len(w.data) - 1)]]
            joined[to - 1] = 0x20
            final = np.minimum(np.arange(n) + longest - 1, run_end)
            k = (final - np.arange(n) + 1).astype(np.int32)
            for a in range(0, n, SLICE):
                part = slice(a, a + SLICE)
                counted = pa.table({"lang": lang[part], "phrase": _strings(joined, begin[part], to[final[part]] - 1),
                                    "k": k[part]}).group_by(["lang", "phrase", "k"]).aggregate([([], "count_all")])
                yield pa.RecordBatch.from_arrays(
                    [names.take(counted["lang"].combine_chunks()), *(counted[c].combine_chunks() for c in
                                                                     ("phrase", "k", "count_all"))],
                    names=["lang", "phrase", "k", "f"])


def _frequent_bits(counted: DataFrame, least: int) -> np.ndarray:
    """A bitmap of the counters that reach ``least``; at most PAIR_SLOTS / 64 rows come to the driver."""
    rows = (counted.groupBy("slot").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
            .groupBy(F.expr("cast(slot div 64 as int)").alias("at"))
            .agg(F.expr("bit_or(shiftleft(1L, slot % 64))").alias("bits")).toArrow())
    bits = np.zeros(PAIR_SLOTS // 64, dtype=np.int64)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return bits.view(U64)


def phrase_counts(stage: Stager, docs: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, phrase, k, f): all phrases of up to ``longest`` words that occur ``least`` times, and the empty one."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.coalesce(docs["lang"], F.lit("und")).alias("lang"), text_of(docs).alias("text"))
    bits = spark.sparkContext.broadcast(_frequent_bits(rows.mapInArrow(_count_pairs, "slot int, f long"), least))
    edges = (rows.mapInArrow(lambda batches: _windows(batches, bits.value, longest),
                             "lang string, phrase string, k int, f long")
             .groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")))
    # A window of ``longest`` words is a count of its own, all else adds to nodes.
    nodes = edges.select("lang", "phrase", "f", "k", F.explode(F.expr("sequence(0, k)")).alias("at")).where(
        (F.col("at") < longest) | (F.col("f") >= least))
    start = F.expr("CASE WHEN at < k THEN substring_index(phrase, ' ', at) ELSE phrase END")
    flow = (nodes.select("lang", start.alias("phrase"), F.col("at").alias("k"), "f")
            .groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f")))
    return stage(flow.where((F.col("f") >= least) | (F.col("k") == 0)), "phrases")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, drop_percent: int = 100,
                 top: int | None = 2000) -> DataFrame:
    """Ranked phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score; the first ``top`` a language."""
    stage = Stager(docs.sparkSession)
    phrases = phrase_counts(stage, docs, longest, least)
    totals = phrases.where("k = 0").select("lang", F.col("f").alias("n"))
    candidates = phrases.where("k >= 2")
    inside = (phrases.where("k >= 3").select("lang", "f", F.explode(F.expr(
        "array(substring_index(phrase, ' ', k - 1), substring_index(phrase, ' ', 1 - k))")).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    own = (candidates.join(inside.hint("merge"), ["lang", "phrase"], "left")
           .where(f"longer IS NULL OR 100 * longer < {int(drop_percent)} * f")
           .select("lang", "phrase", "k", F.col("f").alias("a")))
    # The language's total joins first: the joins and the sum that follow deal the rows by phrase again, so that only
    # each task's first ``top`` rows of a language meet in the window.
    cuts = (own.join(totals, "lang").withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
            .withColumn("head", F.expr("substring_index(phrase, ' ', cut)"))
            .withColumn("tail", F.expr("substring_index(phrase, ' ', cut - k)")))
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = (cuts.join(heads.hint("merge"), ["lang", "head"]).join(tails.hint("merge"), ["lang", "tail"])
              .withColumn("score", F.expr("(cast(1000 as decimal(4, 0)) * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0)))"
                                          " div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"))
              .groupBy("lang", "phrase", "a", "n")
              .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best")))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
                         F.col("best.score").alias("score"))
