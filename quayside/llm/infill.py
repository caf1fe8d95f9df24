"""Fill-in-middle transformation (operator 12): a wavelet matrix over character classes finds the cuts.

1. The characters of a chunk of texts are mapped to four classes (other,
   blank, line end, full stop) and stored as a wavelet matrix: one bit array a
   level, stably split by bit, with counts of ones before each 64 bits. The
   rank of a class at a position costs one lookup a level.
2. Units end after a character of certain classes (``UNITS``), and what is
   left at the end of a text is a unit of its own. The number of unit ends
   before a position is the sum of the ranks of those classes, so two ranks
   count a text's units.
3. A hash of the id draws the two cuts, as numbers of units. That sum of ranks
   never falls, so bisection on it finds the position of each cut.
4. Prefix, middle and suffix are put into the drawn form.

All steps work on whole texts and on arrays of many texts at once; a task
holds one chunk (``CHUNK`` characters, at least one text). Rows are
independent: no shuffle.

Cases: a null text counts as empty and stays plain. A null id is hashed as no
digits. Texts that hold a marker stay plain, so an output can always be split
again (:func:`restored`). Rows that repeat an id draw the same numbers. An
empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ship_package, text_of

OTHER, BLANK, LINE_END, STOP = range(4)
UNITS = {"lines": (LINE_END,), "sentences": (LINE_END, STOP), "words": (BLANK, LINE_END),
         "chars": (OTHER, BLANK, LINE_END, STOP)}
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
CHUNK = 1 << 20

_CLASS = np.zeros(128, dtype=np.uint8)
_CLASS[[0x20, 0x09]] = BLANK
_CLASS[0x0A] = LINE_END
_CLASS[[0x21, 0x2E, 0x3F]] = STOP


class WaveletMatrix:
    """Ranks of the symbols of an array of small numbers."""

    def __init__(self, symbols: np.ndarray, bits: int = 2):
        self.levels = []
        for bit in reversed(range(bits)):
            ones = (symbols >> bit) & 1
            packed = np.zeros((len(ones) // 64 + 1) * 8, dtype=np.uint8)
            packed[:(len(ones) + 7) // 8] = np.packbits(ones, bitorder="little")
            words = packed.view(np.uint64)
            before = np.zeros(len(words), dtype=np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((bit, words, before, len(ones) - int(ones.sum())))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: int, position: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each position."""
        at, start = np.asarray(position, dtype=np.int64), np.zeros(1, dtype=np.int64)
        for bit, words, before, zeros in self.levels:
            ones, first = _ones(words, before, at), _ones(words, before, start)
            if symbol >> bit & 1:
                at, start = zeros + ones, zeros + first
            else:
                at, start = at - ones, start - first
        return at - start

    def ends(self, classes: tuple[int, ...], position: np.ndarray) -> np.ndarray:
        """How many characters of ``classes`` stand before each position."""
        return sum(self.rank(c, position) for c in classes)

    def locate(self, classes: tuple[int, ...], count: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first position between ``low`` and ``high`` with ``count`` characters of ``classes`` before it."""
        low, high = low.copy(), high.copy()
        while (low < high).any():
            half = (low + high) // 2
            enough = self.ends(classes, half) >= count
            high = np.where(enough, half, high)
            low = np.where(enough, low, np.minimum(half + 1, high))
        return low


def _ones(words: np.ndarray, before: np.ndarray, position: np.ndarray) -> np.ndarray:
    word = position >> 6
    mask = (np.uint64(1) << (position & 63).astype(np.uint64)) - np.uint64(1)
    return before[word] + np.bitwise_count(words[word] & mask)


def classes_of(text: str) -> np.ndarray:
    """The class of each code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(points < 128, _CLASS[np.minimum(points, 127)], np.uint8(OTHER))


def draws(doc_id: int | None, seed: int) -> tuple[int, ...]:
    """Four numbers of 32 bits from the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k:k + 8], 16) for k in range(0, 32, 8))


def cut_texts(texts: list[str], drawn: list[tuple[int, ...]], unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text and the code points before its two cuts."""
    classes = UNITS[unit]
    symbols = classes_of("".join(texts))
    stops = np.cumsum([0, *map(len, texts)])
    start, end = stops[:-1], stops[1:]
    matrix = WaveletMatrix(symbols)
    before = matrix.ends(classes, start)
    whole = matrix.ends(classes, end) - before
    last = symbols[np.maximum(end - 1, 0)] if len(symbols) else np.zeros(len(texts), dtype=np.uint8)
    units = whole + ((end > start) & ~np.isin(last, classes))
    first = np.array([d[0] for d in drawn], dtype=np.int64) % (units + 1)
    second = np.array([d[1] for d in drawn], dtype=np.int64) % (units + 1)

    def position(count):
        found = matrix.locate(classes, before + np.minimum(count, whole), start, end)
        return np.where(count > whole, end, found) - start

    return units, position(np.minimum(first, second)), position(np.maximum(first, second))


def _chunks(ids: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    first, held = 0, 0
    for k, text in enumerate(texts):
        if held and held + len(text) > CHUNK:
            yield ids[first:k], texts[first:k]
            first, held = k, 0
        held += len(text)
    if first < len(texts):
        yield ids[first:], texts[first:]


def fill_in_middle(docs: DataFrame, unit: str = "lines", percent: int = 100, spm_percent: int = 50,
                   seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output.

    ``percent`` of the documents are transformed, ``spm_percent`` of those
    with the suffix first.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {', '.join(UNITS)}, not {unit}")
    ship_package(docs.sparkSession)
    rows = docs.select("doc_id", text_of(docs).alias("text"))
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, "
              "middle_chars long, output string")

    def transform(batches):
        for batch in batches:
            for ids, texts in _chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                drawn = [draws(i, seed) for i in ids]
                units, first, second = cut_texts(texts, drawn, unit)
                forms, outputs = [], []
                for text, (_, _, h3, h4), a, b in zip(texts, drawn, first.tolist(), second.tolist()):
                    if not text or h3 % 100 >= percent or PREFIX in text or SUFFIX in text or MIDDLE in text:
                        forms.append("plain")
                        outputs.append(text)
                    elif h4 % 100 < spm_percent:
                        forms.append("spm")
                        outputs.append(SUFFIX + text[b:] + PREFIX + text[:a] + MIDDLE + text[a:b])
                    else:
                        forms.append("psm")
                        outputs.append(PREFIX + text[:a] + SUFFIX + text[b:] + MIDDLE + text[a:b])
                plain = np.array([f == "plain" for f in forms])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, type=batch.column(0).type), pa.array(units, type=pa.int64()), pa.array(forms),
                     pa.array(first, type=pa.int64(), mask=plain), pa.array(second - first, type=pa.int64(), mask=plain),
                     pa.array(outputs, type=pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(transform, schema)


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made from."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)
    part = [F.get(parts, k) for k in range(4)]
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))
