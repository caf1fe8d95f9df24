"""Approximate nearest neighbours (operator 11): multi-index hashing over learned rotated binary codes.

1. A model is fitted on at most ``SAMPLE`` vectors, chosen by hash: rotations
   that bring the directions near the corners of a cube (iterative
   quantisation from several starts), and how the Hamming distance of two
   codes spreads around what their angle makes likely. Codes have ``BITS``
   bits or a little more.
2. Every row is coded and put into blocks of at most ``BLOCK`` rows, which hold
   rows of similar length. A block is dealt round robin, so equal rows or ids
   do not meet in one task.
3. Every query is compared with the sample: its ``k``-th best product there is
   a product that its answer must reach, and the distance of those ``k`` is the
   least radius, so that ``k`` rows are always found. Queries are put into
   blocks too.
4. Each block of rows meets each block of queries once, dealt by groups of row
   blocks. A block of rows is indexed by each 8-bit substring of the codes:
   rows sorted by value, and the start of each value's list. From the product
   to reach and the block's lengths follows the angle to reach, and from that
   the Hamming radius: ``SPREAD`` standard deviations above the likely
   distance. The radius is shared out over the substrings; by the pigeonhole
   principle a code within it lies within its share of the query in one
   substring at least, so the lists of all values that near hold every such
   code. Those are checked on the whole code, and the rest is ranked by exact
   products in double precision.
5. The best ``k`` of each query and block are merged (window with a limit per
   task before the shuffle).

Every code within the radius is found; what is approximate is only the radius.
The work is queries times rows in blocks, cut down by the radius: vectors with
near neighbours need few lists, vectors whose neighbours are barely nearer
than chance need most of them.

Cases: rows whose vector is null, zero, holds null or non-finite components or
has another length than most vectors take no part. A row with a null id is a
candidate, last among ties, and no query. Rows that repeat an id are
candidates each, and not for queries of that id; a repeated query id is
answered once, by the vector whose components order first. With fewer
candidates than ``k`` all are returned. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import Stager, ship_package

SAMPLE = 16384
BITS = 256
ROUNDS = 30            # of iterative quantisation
SPREAD = 1.0           # standard deviations
BLOCK = 8192           # rows
QUERY_BLOCK = 1024     # queries
SEED = 11
_NEAR = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :])   # distance of two bytes


@dataclass
class Model:
    rotations: np.ndarray   # dimension x bits
    sample: np.ndarray      # rows, as they are
    sample_ids: np.ndarray
    sample_no_id: np.ndarray
    bias: float             # Hamming distance per bit, above what the angle makes likely
    width: float            # standard deviation, against that of independent bits

    @property
    def bits(self) -> int:
        return self.rotations.shape[1]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        return np.packbits(vectors @ self.rotations > 0, axis=1)

    def radius(self, cosine: np.ndarray) -> np.ndarray:
        """The Hamming distance that a vector with this cosine hardly exceeds."""
        share = np.arccos(np.clip(cosine, -1.0, 1.0)) / math.pi
        likely = self.bits * (share + self.bias)
        return np.minimum(np.floor(likely + SPREAD * self.width * np.sqrt(self.bits * share * (1 - share)) + 1),
                          self.bits).astype(np.int64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Directions; scaled by the largest component first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit(ids: list, vectors: np.ndarray) -> Model:
    """The model of a sample of vectors."""
    rng = np.random.default_rng(SEED)
    unit = _unit(vectors)
    n, dim = unit.shape
    rotations = []
    while sum(r.shape[1] for r in rotations) < BITS:
        turn, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
        for _ in range(ROUNDS):
            left, _, right = np.linalg.svd(unit.T @ np.sign(unit @ turn))
            turn = left @ right
        rotations.append(turn)
    turned = np.concatenate(rotations, axis=1)
    turned = turned[:, :-(-min(BITS, turned.shape[1]) // 8) * 8]
    if turned.shape[1] % 8:
        turned = np.concatenate([turned, turned[:, :8 - turned.shape[1] % 8]], axis=1)
    no_id = np.array([i is None for i in ids], dtype=bool)
    model = Model(turned, vectors, np.array([0 if i is None else i for i in ids], dtype=np.int64), no_id, 0.0, 1.0)
    some = rng.choice(n, min(n, 512), replace=False)
    codes = model.codes(unit)
    cosine = unit[some] @ unit.T
    share = np.arccos(np.clip(cosine, -1.0, 1.0)) / math.pi
    far = np.zeros(share.shape)
    for row, i in enumerate(some):
        far[row] = distance(codes, codes[i])
    off = far - model.bits * share
    alone = np.sqrt(model.bits * share * (1 - share))
    # The nearest tenth of the pairs counts: there lie the radii.
    used = (share <= np.quantile(share, 0.1)) & (alone > 1)
    if used.sum() > 100:
        model.bias = float(off[used].mean() / model.bits)
        model.width = float(max(1.0, np.std((off[used] - model.bias * model.bits) / alone[used])))
    return model


def distance(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The Hamming distance of each code from one."""
    if codes.shape[1] % 8:
        return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int32)
    return np.bitwise_count(codes.view(np.uint64) ^ code.view(np.uint64)).sum(axis=1, dtype=np.int32)


def _matrix(column: pa.Array, dim: int, kind: type) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=kind).reshape(-1, dim)


def _row_blocks(batches, model: Model, dim: int, kind: type) -> Iterator[pa.RecordBatch]:
    def packed(ids, no_id, vectors):
        length = np.linalg.norm(vectors.astype(np.float64), axis=1)
        step = np.floor(np.log2(np.maximum(length, np.finfo(float).tiny)))
        for s in np.unique(step):
            here = np.flatnonzero(step == s)
            held = vectors[here]
            codes = model.codes(_unit(held.astype(np.float64)))
            yield pa.RecordBatch.from_pylist([{
                "shortest": float(length[here].min()), "longest": float(length[here].max()),
                "ids": ids[here].tobytes(), "no_id": no_id[here].tobytes(), "vectors": held.tobytes(),
                "codes": codes.tobytes()}], schema=pa.schema([
                    ("shortest", pa.float64()), ("longest", pa.float64()), ("ids", pa.binary()),
                    ("no_id", pa.binary()), ("vectors", pa.binary()), ("codes", pa.binary())]))

    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            ids = part.column(0)
            held.append((np.asarray(ids.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64),
                         ids.is_null().to_numpy(zero_copy_only=False), _matrix(part.column(1), dim, kind)))
            n += part.num_rows
            while n >= BLOCK:
                whole = [np.concatenate(x) for x in zip(*held)]
                yield from packed(*(x[:BLOCK] for x in whole))
                held, n = [tuple(x[BLOCK:] for x in whole)], n - BLOCK
    if n:
        yield from packed(*(np.concatenate(x) for x in zip(*held)))


def _query_blocks(batches, model: Model, dim: int, k: int) -> Iterator[pa.RecordBatch]:
    sample_codes = model.codes(_unit(model.sample))
    for batch in batches:
        for at in range(0, batch.num_rows, QUERY_BLOCK):
            part = batch.slice(at, QUERY_BLOCK)
            ids = np.asarray(part.column(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            vectors = _matrix(part.column(1), dim, np.float64)
            product = vectors @ model.sample.astype(np.float64).T
            own = (model.sample_ids[None, :] == ids[:, None]) & ~model.sample_no_id[None, :]
            product[own] = -np.inf
            codes = model.codes(_unit(vectors))
            reach, floor = np.full(len(ids), -np.inf), np.full(len(ids), model.bits)
            if product.shape[1] >= k:
                best = np.argpartition(product, product.shape[1] - k, axis=1)[:, product.shape[1] - k:]
                reach = np.take_along_axis(product, best, axis=1).min(axis=1)
                floor = np.array([distance(sample_codes[b], c).max() for b, c in zip(best, codes)])
            yield pa.RecordBatch.from_pylist([{
                "query_ids": ids.tobytes(), "queries": vectors.tobytes(),
                "query_codes": codes.tobytes(), "reach": reach.tobytes(),
                "floor": floor.astype(np.int64).tobytes()}], schema=pa.schema([
                    ("query_ids", pa.binary()), ("queries", pa.binary()), ("query_codes", pa.binary()),
                    ("reach", pa.binary()), ("floor", pa.binary())]))


class SubstringIndex:
    """Lists of the rows of a block by the value of each byte of their codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.rows = np.argsort(codes, axis=0, kind="stable").T.astype(np.int32)
        self.starts = np.stack([np.searchsorted(codes[self.rows[s], s], np.arange(257)) for s in range(codes.shape[1])])

    def lists(self, substring: int, value: int, share: int) -> np.ndarray:
        """The rows whose substring is within ``share`` of ``value``."""
        start = self.starts[substring]
        near = np.flatnonzero(_NEAR[value] <= share)
        return np.concatenate([self.rows[substring, start[v]:start[v + 1]] for v in near])

    def near(self, codes: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """A mask, queries by rows, that holds at least all rows within each query's radius."""
        n, parts = self.codes.shape
        found = np.zeros((len(codes), n), dtype=bool)
        # Shares that sum to radius + 1 - parts: further apart than its share in every substring is further
        # apart than the radius. The first substrings take what does not divide; a share of -1 reads no list.
        total = np.maximum(radius + 1, 0)
        base, more = total // parts - 1, total % parts
        for s in range(parts):
            share = np.minimum(base + (s < more), 8)
            key = codes[:, s].astype(np.int64) * 16 + share + 1
            for one in np.unique(key[share >= 0]):
                held = np.zeros(n, dtype=bool)
                held[self.lists(s, int(one >> 4), int(one & 15) - 1)] = True
                found[key == one] |= held
        return found


def _search(batches, model: Model, dim: int, kind: type, k: int) -> Iterator[pa.RecordBatch]:
    width = model.bits // 8
    for batch in batches:
        for r in range(batch.num_rows):
            row = {name: batch.column(name)[r] for name in batch.schema.names}
            ids = np.frombuffer(row["ids"].as_buffer(), dtype=np.int64)
            no_id = np.frombuffer(row["no_id"].as_buffer(), dtype=bool)
            vectors = np.frombuffer(row["vectors"].as_buffer(), dtype=kind).reshape(-1, dim)
            codes = np.frombuffer(row["codes"].as_buffer(), dtype=np.uint8).reshape(-1, width)
            query_ids = np.frombuffer(row["query_ids"].as_buffer(), dtype=np.int64)
            queries = np.frombuffer(row["queries"].as_buffer(), dtype=np.float64).reshape(-1, dim)
            query_codes = np.frombuffer(row["query_codes"].as_buffer(), dtype=np.uint8).reshape(-1, width)
            reach = np.frombuffer(row["reach"].as_buffer(), dtype=np.float64)
            bound = np.where(reach >= 0, row["longest"].as_py(), row["shortest"].as_py())
            cosine = reach / (bound * np.linalg.norm(queries, axis=1))
            floor = np.frombuffer(row["floor"].as_buffer(), dtype=np.int64)
            radius = np.where(cosine > 1 + 1e-9, -1, np.maximum(model.radius(cosine), floor))
            index = SubstringIndex(codes)
            out = []
            step = max(1, (1 << 25) // max(1, len(ids)))
            for at in range(0, len(query_ids), step):
                near = index.near(query_codes[at:at + step], radius[at:at + step])
                for q, mask in enumerate(near, at):
                    rows = np.flatnonzero(mask)
                    rows = rows[distance(codes[rows], query_codes[q]) <= radius[q]]
                    rows = rows[(ids[rows] != query_ids[q]) | no_id[rows]]
                    # A sum along each row has one order for equal rows, so that ties stay ties.
                    score = (vectors[rows] * queries[q]).sum(axis=1)
                    good = score >= reach[q] - 1e-9 * abs(reach[q])
                    rows, score = rows[good], score[good]
                    best = np.lexsort((ids[rows], no_id[rows], -score))[:k]
                    out.append((np.full(len(best), query_ids[q]), ids[rows[best]], no_id[rows[best]], score[best]))
            if out:
                query_id, vec_id, none, score = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(query_id), pa.array(vec_id, mask=none), pa.array(score)],
                                                 names=["query_id", "vec_id", "score"])


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, embedding) of the rows that take part, and their dimension."""
    good = vectors.select("vec_id", "embedding").where(
        "embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        " AND exists(embedding, x -> x <> 0)")
    most = good.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).first()
    dim = most["dim"] if most else 0
    return good.where(F.size("embedding") == dim), dim


def nearest(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The ``k`` rows with the largest inner product found for each query: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``every``.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    stage = Stager(spark)
    good, dim = usable(vectors)
    kind = np.float32 if good.schema["embedding"].dataType.elementType.simpleString() == "float" else np.float64
    sample = good.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id", "embedding").limit(SAMPLE).toArrow()
    if sample.num_rows == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    model = spark.sparkContext.broadcast(
        fit(sample["vec_id"].to_pylist(), _matrix(sample["embedding"].combine_chunks(), dim, np.float64)))
    n_blocks = -(-good.count() // BLOCK)
    rows = stage(good.repartition(n_blocks).mapInArrow(
        lambda b: _row_blocks(b, model.value, dim, kind),
        "shortest double, longest double, ids binary, no_id binary, vectors binary, codes binary")
        .withColumn("group", F.spark_partition_id()), "rows")
    asked = good.where(f"vec_id % {int(every)} = 0").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    queries = stage(asked.mapInArrow(lambda b: _query_blocks(b, model.value, dim, k),
                                     "query_ids binary, queries binary, query_codes binary, reach binary, floor binary"),
                    "queries")
    # Each block of rows has a group; the task that holds it meets the blocks of queries one by one. Queries are
    # the streamed side of the merge, so what a task holds does not grow with them.
    numbers = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    pairs = (queries.withColumn("group", numbers).repartition(4 * n_blocks, "group")
             .join(rows.repartition(4 * n_blocks, "group").hint("merge"), "group")
             .select("shortest", "longest", "ids", "no_id", "vectors", "codes",
                     "query_ids", "queries", "query_codes", "reach", "floor"))
    found = stage(pairs.mapInArrow(lambda b: _search(b, model.value, dim, kind, k),
                                   "query_id long, vec_id long, score double"), "found")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
