"""Packing documents into sequences (operator 3): sum-of-squares online packing.

A document's ids are cut into full sequences and a rest. A rest goes to the
fill level that keeps the sum over levels of (open sequences at that level)
squared smallest; a level array holds those counts, so a step costs one
vector pass over the levels and no search among sequences. When the open
sequences reach ``max_open``, and at the end of a task, the emptiest open
sequences are cut to fill the fullest, so a task leaves one partly filled
sequence at most, whose length is padded.

Each input partition is packed on its own, so nothing is shuffled, memory is
bounded by the ids of ``max_open`` open sequences, the document at hand and the
rows not yet sent on; a waiting document keeps only the ids of its rest, less
than a sequence. A lost executor repeats only its own partitions, with the same
result.

Ids come from the rank file of the same vocabulary, read by a faster library,
and the added tokens from the vocabulary's JSON file (the two libraries give
equal ids; tests compare them). That library's pattern fails on very long runs
of white space, so texts with a run of ``LONG_SPACE`` characters or more are
read with the JSON file and its own library.

Cases: a null text is empty and packs its end id alone. The string of an added
token in a text is that token's one id, as the JSON file has it, and the text
before and after it is cut into words on its own. Rows that repeat an id are
packed one by one. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ship_package, text_of

SEQUENCE = 2048
MAX_OPEN = 20_000
LONG_SPACE = 50_000
FLUSH_ROWS, FLUSH_BYTES = 2000, 1 << 24   # rows and bytes of ids that a task sends on together
END_ID = 1
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                   ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def json_of(ranks_path: str) -> str:
    return os.path.splitext(ranks_path)[0] + ".json"


def added_tokens(ranks_path: str) -> dict[str, int]:
    """The added tokens of the JSON file beside the rank file, by string."""
    with open(json_of(ranks_path), encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if odd := [t["content"] for t in tokens if t["lstrip"] or t["rstrip"] or t["single_word"]]:
        raise ValueError(f"added tokens that take or need white space are not supported: {odd}")
    return {t["content"]: t["id"] for t in tokens}


@functools.cache
def encoder(ranks_path: str, pattern: str):
    """Text to ids; made once in a worker."""
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                 special_tokens=added_tokens(ranks_path))
    fast = functools.partial(encoding.encode, allowed_special="all")
    spaces = re.compile(r"\s{%d}" % LONG_SPACE)

    def encode(text: str) -> list[int]:
        if len(text) >= LONG_SPACE and spaces.search(text):
            return slow_encoder(ranks_path).encode(text, add_special_tokens=False).ids
        return fast(text)

    return encode


@functools.cache
def slow_encoder(ranks_path: str):
    """The JSON file's own library."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(json_of(ranks_path))


class Levels:
    """Open sequences by fill level, and the pieces each holds."""

    def __init__(self, size: int, max_open: int, emit):
        self.size, self.max_open, self.emit = size, max_open, emit
        self.counts = np.zeros(size + 1, dtype=np.int64)
        # The counts, far below zero where no sequence is open, so that no move starts there.
        self.taken = np.full(size + 1, -(1 << 40), dtype=np.int64)
        self.open: dict[int, list] = {}
        self.n_open = 0

    def count(self, level: int, by: int) -> None:
        self.counts[level] += by
        self.taken[level] = self.counts[level] or -(1 << 40)

    def add(self, piece: tuple, length: int) -> None:
        """Place a piece shorter than a sequence."""
        size, counts = self.size, self.counts
        # The change of the sum of squares, by choice: a new sequence adds 2 N[length] + 1; moving
        # one from level h to h + length adds 2 (N[h + length] - N[h] + 1); filling one up adds
        # 1 - 2 N[size - length].
        level, least = 0, 2 * int(counts[length]) + 1
        if length < size - 1:
            moved = counts[1 + length:size] - self.taken[1:size - length]
            best = int(moved.argmin())
            if (change := 2 * (int(moved[best]) + 1)) < least:
                level, least = 1 + best, change
        if counts[size - length] and 1 - 2 * int(counts[size - length]) <= least:
            level = size - length
        if level == 0:
            held = []
            self.n_open += 1
        else:
            held = self.open[level].pop()
            self.count(level, -1)
        held.append((piece, length))
        if level + length == size:
            self.n_open -= 1
            self.emit(held)
        else:
            self.count(level + length, 1)
            self.open.setdefault(level + length, []).append(held)
        if self.n_open >= self.max_open:
            self.flush()

    def flush(self) -> None:
        """Cut the emptiest open sequences to fill the fullest; one partly filled stays at most."""
        rest = [held for level in sorted(self.open, reverse=True) for held in self.open[level]]
        self.open.clear()
        self.counts[:] = 0
        self.taken[:] = -(1 << 40)
        self.n_open = 0
        lo, hi = 0, len(rest) - 1
        spare: list = []
        while lo <= hi:
            held = rest[lo]
            lo += 1
            room = self.size - sum(n for _, n in held)
            while room and (spare or lo <= hi):
                if not spare:
                    spare = rest[hi]
                    hi -= 1
                (doc, start), n = spare.pop()
                took = min(n, room)
                held.append(((doc, start), took))
                room -= took
                if took < n:
                    spare.append(((doc, start + took), n - took))
            self.emit(held)
        if spare:
            self.emit(spare)


def packer(ranks_path: str, pattern: str, size: int, end_id: int, max_open: int):
    """The function of one partition for ``mapInArrow``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, pattern)
        out: list[tuple] = []
        held_bytes = 0
        rests: dict[int, list] = {}  # number -> [doc_id, ids of the rest, its start, the document's ids, ids still open]
        sequence = TaskContext.get().partitionId() << 40
        number = 0

        def put(doc_id, start: int, ids: bytes, total: int, offset: int) -> None:
            nonlocal held_bytes
            out.append((doc_id, start, len(ids) // 4, ids, total, sequence, offset))
            held_bytes += len(ids)

        def emit(held: list) -> None:
            nonlocal sequence
            offset = 0
            for (doc, start), n in held:
                doc_id, blob, at, total, _ = rest = rests[doc]
                put(doc_id, start, blob[4 * (start - at):4 * (start - at + n)], total, offset)
                offset += n
                rest[4] -= n
                if not rest[4]:
                    del rests[doc]
            sequence += 1

        levels = Levels(size, max_open, emit)

        def made() -> pa.RecordBatch:
            nonlocal held_bytes
            columns = list(zip(*out)) or [[]] * len(ARROW)
            out.clear()
            held_bytes = 0
            return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, ARROW)], schema=ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                blob = np.array(encode(text.as_py()), dtype="<u4").tobytes() + end
                total = len(blob) // 4
                whole = total // size * size
                for start in range(0, whole, size):
                    put(doc_id, start, blob[4 * start:4 * (start + size)], total, 0)
                    sequence += 1
                    if held_bytes >= FLUSH_BYTES:
                        yield made()
                if total > whole:
                    # Of a long document only its rest has to wait.
                    rests[number] = [doc_id, blob[4 * whole:], whole, total, total - whole]
                    levels.add((number, whole), total - whole)
                number += 1
                if len(out) >= FLUSH_ROWS:
                    yield made()
        levels.flush()
        yield made()

    return pack


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, size: int = SEQUENCE, end_id: int = END_ID,
                   max_open: int = MAX_OPEN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit numbers. ``ranks_path`` names
    the vocabulary's rank file on every worker; its JSON file lies beside it.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(packer(ranks_path, pattern, size, end_id, max_open), SCHEMA)
