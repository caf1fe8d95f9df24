"""Substring deduplication (operator 4): suffix trees over prefix-partitioned suffixes of the words.

A word is removed if a run of ``min_words`` words that covers it also starts in
a document with a smaller id.

1. Documents are dealt into chunks by a hash of the id; a chunk fits in memory.
2. Each run of ``min_words`` words has an anchor, its smallest ``ANCHOR``-word
   hash. Equal runs have equal anchors, so a run can only repeat in another
   chunk if its anchor does. Distinct anchors per chunk are dealt by hash, and
   those of two or more chunks go back to their chunks: other suffixes can
   reach no deep internal node and are not sent.
3. The suffixes that remain are dealt by a prefix into groups of about
   ``GROUP_BYTES``. The prefix has variable length: neighbouring suffixes
   around one anchor travel as one record under the anchor's words, and where
   that prefix would bring more than ``HEAVY`` records, each suffix travels
   under its whole ``min_words`` words. Equal records of a chunk are sent once,
   by their smallest id, so a passage that a third of all documents hold
   brings one record per chunk.
4. A group sorts its suffixes and takes the lengths of common prefixes of
   neighbours: together they are its suffix tree. Internal nodes of depth
   ``min_words`` are the repeats; every suffix below such a node whose id is
   not the node's smallest goes back to its chunk.
5. Each chunk adds the repeats inside itself, marks the covered words and
   joins the rest.

Cases: a null or empty text has no words. Texts shorter than ``min_words``
words lose nothing. A null id orders above every id. Rows with equal ids are
one document, so they do not remove words from each other. An empty table
gives an empty result. Other columns are not read. Words are compared by
32 bits of their hash at each of the ``min_words`` places, runs inside one
chunk by 64 bits.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ship_package, text_of
from quayside.llm.words import U64, Words, grams, mix, within, words

MIN_WORDS = 13
ANCHOR = 4
CHUNK_BYTES = 8 << 20
GROUP_BYTES = 4 << 20
BLOCK_BYTES = 4 << 20
HEAVY = 4096
NO_ID = np.iinfo(np.int64).max

_ANCHORS = pa.schema([("block", pa.int64()), ("chunk", pa.int64()), ("anchors", pa.binary()), ("counts", pa.binary())])
ANCHORS = "block long, chunk long, anchors binary, counts binary"
_HITS = pa.schema([("chunk", pa.int64()), ("anchors", pa.binary()), ("heavy", pa.binary())])
HITS = "chunk long, anchors binary, heavy binary"
_RECORDS = pa.schema([("group", pa.int64()), ("chunk", pa.int64()), ("docs", pa.binary()), ("places", pa.binary()),
                      ("lengths", pa.binary()), ("codes", pa.binary())])
RECORDS = "group long, chunk long, docs binary, places binary, lengths binary, codes binary"
_FOUND = pa.schema([("chunk", pa.int64()), ("docs", pa.binary()), ("places", pa.binary())])
FOUND = "chunk long, docs binary, places binary"
_SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                   ("removed", pa.list_(_SPAN)), ("text", pa.string())])
KEPT = "doc_id long, n_words long, n_removed long, removed array<struct<start:bigint,length:bigint>>, text string"


class Runs:
    """The runs of ``size`` words of a few texts, and the anchor of each."""

    def __init__(self, w: Words, doc: np.ndarray, size: int):
        self.w, self.size = w, size
        self.hashes = w.hashes()
        self.start = np.flatnonzero(within(w.first, size))
        text = np.searchsorted(w.first, self.start, side="right") - 1
        self.doc = doc[w.row + text]
        self.place = self.start - w.first[text]
        self.text = text
        pieces = grams(self.hashes, ANCHOR)
        width = size - ANCHOR + 1
        if len(self.start):
            around = np.lib.stride_tricks.sliding_window_view(pieces, width)[self.start]
            at = around.argmin(axis=1)
            self.anchor_at = self.start + at
            self.anchor = pieces[self.anchor_at]
        else:
            self.anchor_at, self.anchor = self.start, self.hashes[:0]

    def super_runs(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and number of runs, of neighbouring chosen runs with the same anchor place."""
        at = np.flatnonzero(chosen)
        if not len(at):
            return at, at
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(self.anchor_at[at]) != 0) | (np.diff(self.text[at]) != 0)
        first = np.flatnonzero(new)
        return at[first], np.diff(np.append(first, len(at)))

    def codes(self, first: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """32-bit word codes of consecutive words, one stretch after the other."""
        inside = np.arange(int(n_words.sum())) - np.repeat(np.cumsum(n_words) - n_words, n_words)
        return self.hashes[np.repeat(self.start[first], n_words) + inside].astype(np.uint32)


def _ids(table: pa.Table) -> np.ndarray:
    return np.array(table["doc_id"].fill_null(int(NO_ID)))


def _runs(table: pa.Table, size: int):
    ids, row = _ids(table), 0
    for batch in table.select(["text"]).to_batches():
        for w in words(batch.column(0)):
            yield Runs(w, ids[row:row + batch.num_rows], size)
        row += batch.num_rows


def _sorted_pieces(order_by: np.ndarray):
    """Order, and the bounds of equal values."""
    order = np.argsort(order_by, kind="stable")
    values, start = np.unique(order_by[order], return_index=True)
    return order, values, start, np.append(start[1:], len(order))


def _anchors(size: int, blocks: int):
    def run(table: pa.Table) -> pa.Table:
        chunk = table["chunk"][0].as_py()
        found = [r.anchor[r.super_runs(np.ones(len(r.start), dtype=bool))[0]] for r in _runs(table, size)]
        anchors, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, U64), np.zeros(0))
        counts = np.minimum(counts, 0xFFFFFFFF).astype(np.uint32)
        block = (mix(anchors) % U64(blocks)).astype(np.int64)
        order, values, start, end = _sorted_pieces(block)
        anchors, counts = anchors[order], counts[order]
        return pa.table([pa.array(values, pa.int64()), pa.array([chunk] * len(values), pa.int64()),
                         pa.array([anchors[a:b].tobytes() for a, b in zip(start, end)], pa.binary()),
                         pa.array([counts[a:b].tobytes() for a, b in zip(start, end)], pa.binary())], schema=_ANCHORS)
    return run


def _shared(heavy: int):
    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, dtype=U64) for x in table["anchors"].to_pylist()]
        anchors = np.concatenate(parts)
        counts = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in table["counts"].to_pylist()])
        chunk = np.repeat(np.array(table["chunk"]), [len(p) for p in parts])
        values, at, n = np.unique(anchors, return_inverse=True, return_counts=True)
        total = np.bincount(at, weights=counts, minlength=len(values))
        keep = n[at] > 1
        order, chunks, start, end = _sorted_pieces(chunk[keep])
        anchors, large = anchors[keep][order], (total[at] > heavy)[keep][order]
        return pa.table([pa.array(chunks, pa.int64()),
                         pa.array([anchors[a:b].tobytes() for a, b in zip(start, end)], pa.binary()),
                         pa.array([large[a:b].tobytes() for a, b in zip(start, end)], pa.binary())], schema=_HITS)
    return run


def _records(size: int, groups: int):
    def run(docs: pa.Table, hits: pa.Table) -> pa.Table:
        if not docs.num_rows or not hits.num_rows:
            return _RECORDS.empty_table()
        chunk = docs["chunk"][0].as_py()
        anchors = np.concatenate([np.frombuffer(x, dtype=U64) for x in hits["anchors"].to_pylist()])
        heavy = np.concatenate([np.frombuffer(x, dtype=bool) for x in hits["heavy"].to_pylist()])
        order = np.argsort(anchors)
        anchors, heavy = anchors[order], heavy[order]
        sent: list[tuple] = []  # key, prefix, doc, place, words, codes
        for r in _runs(docs, size):
            at = np.searchsorted(anchors, r.anchor)
            known = np.take(anchors, at, mode="clip") == r.anchor
            large = known & np.take(heavy, at, mode="clip")
            whole = grams(r.hashes, size)[r.start] if len(r.start) else r.hashes[:0]
            first, n = r.super_runs(known & ~large)
            # The key of a record: its anchor, where the anchor lies, and its first and last run.
            key = mix(whole[first] ^ mix(whole[first + n - 1] + n.astype(U64)))
            single = np.flatnonzero(large)
            n = np.append(n, np.ones(len(single), dtype=np.int64)) + size - 1
            key = np.append(key, whole[single])
            prefix = np.append(r.anchor[first], whole[single])
            first = np.append(first, single)
            sent.append((key, prefix, r.doc[first], r.place[first], n, r.codes(first, n)))
        key, prefix, doc, place, n, codes = (np.concatenate(c) for c in zip(*sent))
        if not len(key):
            return _RECORDS.empty_table()
        # Of equal records the smallest id goes.
        order = np.lexsort((place, doc, key))
        one = order[np.concatenate([[True], key[order][1:] != key[order][:-1]])]
        group = (mix(prefix[one]) % U64(groups)).astype(np.int64)
        order, values, start, end = _sorted_pieces(group)
        one = one[order]
        begin = np.cumsum(n) - n
        rows = []
        for g, a, b in zip(values, start, end):
            k = one[a:b]
            inside = np.arange(int(n[k].sum())) - np.repeat(np.cumsum(n[k]) - n[k], n[k])
            rows.append((int(g), chunk, doc[k].tobytes(), place[k].astype(np.uint32).tobytes(),
                         n[k].astype(np.uint8).tobytes(), codes[np.repeat(begin[k], n[k]) + inside].tobytes()))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORDS)], schema=_RECORDS)
    return run


def suffix_tree(suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes (one row of codes each) and the common prefix length of each with the one before."""
    n, size = suffixes.shape
    wide = np.zeros((n, size + size % 2), dtype=np.uint64)
    wide[:, :size] = suffixes
    pairs = (wide[:, 0::2] << U64(32)) | wide[:, 1::2]
    order = np.lexsort(pairs.T[::-1])
    same = suffixes[order][1:] == suffixes[order][:-1]
    common = np.where(same.all(axis=1), size, same.argmin(axis=1))
    return order, np.concatenate([[0], common])


def _trees(size: int):
    def run(table: pa.Table) -> pa.Table:
        def column(name, kind):
            return np.concatenate([np.frombuffer(x, dtype=kind) for x in table[name].to_pylist()])

        n_of = [len(x) for x in table["lengths"].to_pylist()]
        chunk = np.repeat(np.array(table["chunk"]), n_of)
        doc, place = column("docs", np.int64), column("places", np.uint32).astype(np.int64)
        n, codes = column("lengths", np.uint8).astype(np.int64), column("codes", np.uint32)
        # A record of n words has n - size + 1 suffixes that are long enough.
        k = n - size + 1
        inside = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        begin = np.repeat(np.cumsum(n) - n, k) + inside
        record = np.repeat(np.arange(len(n)), k)
        order, common = suffix_tree(codes[begin[:, None] + np.arange(size)[None]])
        # Internal nodes of depth ``size``: stretches of suffixes that agree throughout.
        node = np.cumsum(common < size) - 1
        owner = doc[record[order]]
        least = np.minimum.reduceat(owner, np.flatnonzero(common < size))
        gone = order[owner > least[node]]
        where = chunk[record[gone]]
        out_doc, out_place = doc[record[gone]], place[record[gone]] + inside[gone]
        order, chunks, start, end = _sorted_pieces(where)
        out_doc, out_place = out_doc[order], out_place[order].astype(np.uint32)
        return pa.table([pa.array(chunks, pa.int64()),
                         pa.array([out_doc[a:b].tobytes() for a, b in zip(start, end)], pa.binary()),
                         pa.array([out_place[a:b].tobytes() for a, b in zip(start, end)], pa.binary())], schema=_FOUND)
    return run


def _kept(size: int):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _KEPT.empty_table()
        ids = _ids(docs)
        parts = list(_runs(docs, size))
        whole = np.concatenate([grams(r.hashes, size)[r.start] if len(r.start) else r.hashes[:0] for r in parts])
        owner = np.concatenate([r.doc for r in parts])
        # Runs of this chunk, each with the smallest id here that holds it.
        values, at = np.unique(whole, return_inverse=True)
        least = np.full(len(values), NO_ID)
        np.minimum.at(least, at, owner)
        gone = owner > least[at]
        if found.num_rows:
            # A run found elsewhere under a smaller id: so is every equal run here.
            doc = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in found["docs"].to_pylist()])
            place = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in found["places"].to_pylist()])
            hit = np.unique(mix(doc.astype(U64) ^ mix(place.astype(U64) + U64(1))))
            own = mix(owner.astype(U64) ^ mix(np.concatenate([r.place for r in parts]).astype(U64) + U64(1)))
            named = np.take(hit, np.searchsorted(hit, own), mode="clip") == own
            beaten = np.zeros(len(values), dtype=bool)
            beaten[at[named & (owner == least[at])]] = True
            gone |= named | beaten[at]
        rows, before = [], 0
        for r in parts:
            w, here = r.w, gone[before:before + len(r.start)]
            before += len(r.start)
            mark = np.zeros(len(r.hashes) + 1, dtype=np.int64)
            np.add.at(mark, r.start[here], 1)
            np.add.at(mark, r.start[here] + size, -1)
            covered = np.cumsum(mark[:-1]) > 0
            for t in range(len(w)):
                a, b = w.first[t], w.first[t + 1]
                text = w.data[w.offset[t]:w.offset[t + 1]].tobytes().split()
                cut = covered[a:b]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]])))
                if len(edges):
                    text = compress(text, ~cut)
                rows.append((int(b - a), int(cut.sum()),
                             [{"start": int(x), "length": int(y - x)} for x, y in zip(edges[::2], edges[1::2])],
                             b" ".join(text).decode()))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(_KEPT)[1:])]
        return pa.table([pa.array(ids, pa.int64(), mask=ids == NO_ID), *columns], schema=_KEPT)
    return run


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, heavy: int = HEAVY) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, removed (word ranges), text (the words that stay).

    The documents are shuffled once, by chunk; Spark reuses that exchange in
    the three places that read it.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, groups, blocks = (int(-(-size // part)) or 1 for part in (CHUNK_BYTES, GROUP_BYTES, BLOCK_BYTES))
    rows = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk"), "doc_id", "text")
    by_chunk = rows.groupBy("chunk")
    hits = (by_chunk.applyInArrow(_anchors(min_words, blocks), ANCHORS)
            .groupBy("block").applyInArrow(_shared(heavy), HITS))
    found = (by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(_records(min_words, groups), RECORDS)
             .groupBy("group").applyInArrow(_trees(min_words), FOUND))
    return by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(_kept(min_words), KEPT)
