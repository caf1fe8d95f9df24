"""N-gram Jaccard join (operator 9): a blocked sparse product of the document by n-gram incidence.

Two documents link when ``100 * intersection >= percent * union`` of their
sets of word n-grams. The work is exact; bounds only discard pairs that cannot
link.

1. One pass over the texts: the set size, a 128-bit signature and a parity map
   of each set, and a table of n-gram frequencies (``SLOTS`` counters, whatever
   the corpus size; a larger table orders a larger corpus better). Documents with equal sets become one node.
2. A second pass orders each set from rare to frequent n-grams and keeps the
   prefix that any linking partner must meet. Columns of the incidence (n-grams
   in prefixes) that only one node has are dropped; the rest is dealt by
   n-gram, so each task multiplies its own block of columns.
3. First product: per n-gram the node with the fewest rare n-grams before it is
   the centre, and only products with the centre are formed, so their number
   is linear in the entries. Pairs that their sizes, places or parity maps rule
   out are discarded; for the others, overlap counts are accumulated over all
   blocks, and pairs below the bound that follows from the two sizes and the
   overlap so far are discarded. The sets of the rest are compared.
4. Linked nodes are merged into components. Second product: n-grams whose nodes
   lie in several components give the remaining pairs across components, cut by
   the same bounds inside the join. A group of copies is one component by then
   and makes no pairs. These are compared too, and components are final.

Bounds, with sizes n1 and n2 and an overlap at places p1 and p2 of the ordered
sets: the intersection is at most min(n1 - p1, n2 - p2), and must be at least
percent * (n1 + n2) / (100 + percent). Two parity maps differ in at most as
many bits as the sets have elements apart.

Cases: a null or empty text has no n-gram and links with nothing. A text with
fewer words than an n-gram has its whole sequence as one. Rows that repeat an
id are documents of their own. A component whose ids are all null has a null
component id. An empty table gives an empty result. Other columns are not read.
N-grams are compared by 64-bit hashes, and so are whole sets: equal hashes count as equal sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Stager, keep_rows, ship_package, text_of
from quayside.llm.components import components
from quayside.llm.exact import content_hash
from quayside.llm.words import U64, grams, mix, words

SLOTS = 1 << 19          # counters of n-gram frequencies
PARITY_BITS = 1024
_BASE_SHORT = U64(0xA0761D6478BD642F)
SHORT = ["b0", "b1", "b2", "b3"]
ID_SLOTS = 1 << 24       # bits of the map of ids whose sets are needed


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-gram hashes) of each text."""
    for w in words(column, lower=True):
        hashes = w.hashes()
        runs = grams(hashes, size)
        for k in range(len(w)):
            a, b = w.first[k], w.first[k + 1]
            if b - a >= size:
                yield w.row + k, np.unique(runs[a:b - size + 1])
            elif b > a:
                yield w.row + k, grams(hashes[a:b], int(b - a))
            else:
                yield w.row + k, hashes[:0]


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    place = np.arange(1, len(shingles) + 1, dtype=U64)
    one = mix(shingles * (place * U64(2) + U64(1)))
    two = mix(shingles ^ mix(place))
    h = mix(np.array([one.sum(), two.sum()], dtype=U64) + U64(len(shingles)))
    return int(h[0].view(np.int64)), int(h[1].view(np.int64))


def parity(shingles: np.ndarray) -> bytes:
    bits = np.bincount((mix(shingles) % U64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def short_parity(shingles: np.ndarray) -> np.ndarray:
    """A parity map of 4 times 64 bits, for use inside a join."""
    at = mix(shingles ^ _BASE_SHORT)
    bits = np.bincount((at % U64(256)).astype(np.int64), minlength=256) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def slot(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> U64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("node", pa.int64()), ("second", pa.int64()),
                     ("parity", pa.binary()), ("b0", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64()),
                     ("b3", pa.int64()), ("slots", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
SIGNED = "doc_id long, digest binary, n long, node long, second long, parity binary, b0 long, b1 long, b2 long, b3 long, " \
         "slots array<int>, counts array<bigint>"


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            rows = []
            for _, s in shingle_sets(batch.column(1), size):
                rows.append((len(s), *signature(s), parity(s), *short_parity(s).tolist()) if len(s) else (0, *[None] * 7))
                np.add.at(seen, slot(s), 1)
            none = pa.nulls(len(rows))
            if rows:
                yield pa.record_batch([batch.column(0), batch.column(2),
                                       *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(_SIGNED)[2:])),
                                       none.cast(_SIGNED.field("slots").type), none.cast(_SIGNED.field("counts").type)],
                                      schema=_SIGNED)
        used = np.flatnonzero(seen)
        if len(used):
            row = [*[None] * 10, used.astype(np.int32), seen[used]]
            yield pa.record_batch([pa.array([v], f.type) for v, f in zip(row, _SIGNED)], schema=_SIGNED)
    return run


def prefix_length(n: np.ndarray | int, percent: int):
    """How many of the rarest n-grams a linking partner must meet: n - ceil(percent * n / 100) + 1."""
    return n - (n * percent + 99) // 100 + 1


def _prefixes(size: int, percent: int, frequency: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, s in shingle_sets(batch.column(0), size):
                if len(s):
                    # From rare to frequent; of equal counts the smaller hash first.
                    order = np.argsort(frequency[slot(s)], kind="stable")[:prefix_length(len(s), percent)]
                    rows.append((signature(s)[0], len(s), s[order].view(np.int64)))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.int64(), pa.int64(), pa.list_(pa.int64())))], names=["node", "n", "keys"])
    return run


def _sets_of(size: int, wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.array(batch.column(0)) - 1
            keep = np.flatnonzero((wanted[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
            rows = [(signature(s)[0], s.tobytes())
                    for _, s in shingle_sets(batch.column(1).take(pa.array(keep)), size) if len(s)]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary()))],
                                      names=["node", "shingles"])
    return run


def _near_parity(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, pa_, pb = (c.to_pylist() for c in batch.columns)
            if not a:
                continue
            maps = [np.frombuffer(b"".join(p), dtype=np.uint64).reshape(len(a), -1) for p in (pa_, pb)]
            apart = np.bitwise_count(maps[0] ^ maps[1]).sum(axis=1, dtype=np.int64)
            total = np.array(na) + np.array(nb)
            # |intersection| = (total - apart) / 2 at most.
            keep = (100 + percent) * (total - apart) >= 2 * percent * total
            yield pa.record_batch([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))],
                                  names=["a", "b"])
    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])
    return run


class JaccardJoin:
    """The steps of one join; every table between them is staged.

    With ``digests``, rows also carry their text's digest, and components the
    id and digest of their first row: the smallest id, null last, then the
    smallest digest.
    """

    def __init__(self, docs: DataFrame, size: int, percent: int, digests: bool = False):
        ship_package(docs.sparkSession)
        self.spark, self.size, self.percent = docs.sparkSession, size, percent
        self.stage = Stager(self.spark)
        self.first = ["first"] if digests else []
        digest = content_hash(text_of(docs)) if digests else F.lit(None).cast("binary")
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"),
                                digest.alias("digest"))

    def signatures(self) -> None:
        signed = self.stage(self.docs.mapInArrow(_sign(self.size), SIGNED), "signatures")
        self.members = signed.where("slots IS NULL").select("doc_id", "digest", "n", "node", "second")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
        self.nodes = self.stage(
            signed.where("node IS NOT NULL").groupBy("node").agg(
                F.max("n").alias("n"), F.max("parity").alias("parity"), F.min("doc_id").alias("min_doc"),
                *[F.max(b).alias(b) for b in SHORT], *([first] if self.first else [])), "nodes")
        counted = (signed.where("slots IS NOT NULL").select(F.explode(F.arrays_zip("slots", "counts")).alias("c"))
                   .groupBy("c.slots").agg(F.sum("c.counts").alias("n")))
        # SLOTS rows at most, whatever the input.
        self.frequency = np.zeros(SLOTS, dtype=np.int64)
        for batch in counted.toArrow().to_batches():
            self.frequency[np.array(batch.column(0))] = np.array(batch.column(1))

    def postings(self) -> None:
        prefixes = self.docs.select("text").mapInArrow(
            _prefixes(self.size, self.percent, self.frequency), "node long, n long, keys array<bigint>")
        # Documents with equal sets give equal prefixes; one stays.
        prefixes = self.stage(prefixes.groupBy("node", "n").agg(F.any_value("keys").alias("keys")), "prefixes")
        entries = prefixes.select("node", "n", F.posexplode("keys").alias("pos", "key"))
        shared = self.stage(entries.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "shared")
        self.entries = self.stage(entries.join(shared.hint("merge"), "key"), "entries")

    def fits(self, n1, p1, n2, p2):
        """The size and place bounds of a pair."""
        need = self.percent * (n1 + n2)
        return (((100 + self.percent) * (n1 - p1) >= need) & ((100 + self.percent) * (n2 - p2) >= need)
                & (100 * n1 >= self.percent * n2) & (100 * n2 >= self.percent * n1))

    def star_pairs(self) -> DataFrame:
        e = self.entries
        first = F.min(F.struct((F.col("pos") / F.col("n")).alias("share"), "node", "n", "pos"))
        centre = self.stage(e.groupBy("key").agg(first.alias("c")).select(
            "key", F.col("c.node").alias("node2"), F.col("c.n").alias("n2"), F.col("c.pos").alias("pos2")), "centres")
        met = (e.join(centre.hint("merge"), "key").where("node <> node2")
               .where(self.fits(F.col("n"), F.col("pos"), F.col("n2"), F.col("pos2"))))
        return met.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()

    def accumulated(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose overlap, summed over all blocks of columns, can still reach the bound."""
        e = self.entries
        one = e.select(F.col("node").alias("a"), "key", F.col("n").alias("na"), F.col("pos").alias("p")).hint("merge")
        two = e.select(F.col("node").alias("b"), "key", F.col("n").alias("nb"), F.col("pos").alias("q")).hint("merge")
        summed = pairs.join(one, "a").join(two, ["b", "key"]).groupBy("a", "b").agg(
            F.count(F.lit(1)).alias("overlap"), F.max("na").alias("na"), F.max("nb").alias("nb"),
            F.max("p").alias("p"), F.max("q").alias("q"))
        # Beyond the last place met in both prefixes, the shorter rest is all that can still meet.
        most = F.col("overlap") + F.least(F.col("na") - 1 - F.col("p"), F.col("nb") - 1 - F.col("q"))
        return summed.where((100 + self.percent) * most >= self.percent * (F.col("na") + F.col("nb"))).select("a", "b")

    def cross_pairs(self, labels: DataFrame) -> DataFrame:
        """Pairs across components that share an n-gram and pass the bounds."""
        label = F.coalesce("label", "node").alias("label")
        entries = self.stage(self.entries.join(labels.hint("merge"), "node", "left").select("key", "node", "n", "pos", label),
                             "labelled")
        several = self.stage(entries.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
                             .where("x < y").select("key"), "several")
        left = self.stage(entries.join(several.hint("merge"), "key")
                          .join(self.nodes.select("node", *SHORT).hint("merge"), "node"), "open")
        # A partner of at least its own size has at most ``most`` n-grams; steps of 5 % of the size
        # are join keys, so only sizes that can link meet.
        most = F.floor(F.least((100 + self.percent) * (F.col("n") - F.col("pos")) / self.percent - F.col("n"),
                               100 * F.col("n") / self.percent))
        step = lambda n: F.floor(F.log(n.cast("double")) / F.log(F.lit(1.05)))
        small = (left.withColumn("most", most).where("most >= n")
                 .withColumn("step", F.explode(F.sequence(step(F.col("n")), step(F.col("most"))))).alias("s"))
        large = left.withColumn("step", step(F.col("n"))).alias("l")
        s, t = (lambda c: F.col(f"s.{c}")), (lambda c: F.col(f"l.{c}"))
        apart = sum((F.bit_count(s(b).bitwiseXOR(t(b))) for b in SHORT), F.lit(0))
        pairs = small.join(large.hint("merge"), (s("key") == t("key")) & (s("step") == t("step")) & (s("label") != t("label"))
                           & (t("n") <= s("most")) & ((s("n") < t("n")) | ((s("n") == t("n")) & (s("node") < t("node"))))
                           & self.fits(s("n"), s("pos"), t("n"), t("pos"))
                           & ((100 + self.percent) * (s("n") + t("n") - apart) >= 2 * self.percent * (s("n") + t("n"))))
        return pairs.select(F.least(s("node"), t("node")).alias("a"), F.greatest(s("node"), t("node")).alias("b")).distinct()

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs that link: parity maps and overlap counts discard, then the sets themselves are compared."""
        n = self.nodes
        one = n.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa")).hint("merge")
        two = n.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb")).hint("merge")
        near = self.stage(pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "pa", "pb")
                          .mapInArrow(_near_parity(self.percent), "a long, b long"), "near")
        close = self.stage(self.accumulated(near), "close")
        used = close.select(F.col("a").alias("node")).unionByName(close.select(F.col("b").alias("node"))).distinct()
        # A map of fixed size tells which texts are worth cutting; other texts that share a bit do no harm.
        bits = (n.join(used.hint("merge"), "node").select(at_of("min_doc").alias("at"))
                .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect())
        wanted = np.zeros(ID_SLOTS // 8, dtype=np.uint8)
        for r in bits:
            start = (r["bucket"] - 1) * 4096
            wanted[start:start + 4096] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
        sets = self.stage(self.docs.select(at_of("doc_id").alias("at"), "text")
                          .mapInArrow(_sets_of(self.size, wanted), "node long, shingles binary")
                          .join(used.hint("merge"), "node", "left_semi").dropDuplicates(["node"]), "sets")
        x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")).hint("merge")
        y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")).hint("merge")
        return self.stage(close.join(x, "a").join(y, "b").select("a", "b", "x", "y")
                          .mapInArrow(_linked(self.percent), "a long, b long"), "links")

    def run(self) -> DataFrame:
        self.signatures()
        self.postings()
        star = self.stage(self.star_pairs(), "star-pairs")
        found = self.links(star)
        labels = components(self.stage, found)
        cross = self.cross_pairs(labels).join(star.hint("merge"), ["a", "b"], "left_anti")
        found = found.unionByName(self.links(self.stage(cross, "cross-pairs")))
        labels = components(self.stage, found)
        linked = F.coalesce("label", "node").alias("label")
        nodes = self.stage(self.nodes.join(labels.hint("merge"), "node", "left").select("node", "min_doc", linked, *self.first),
                           "labelled")
        least = self.stage(nodes.groupBy("label").agg(F.min("min_doc").alias("component_id"),
                                                      *[F.min(c).alias(c) for c in self.first]), "least")
        named = self.stage(nodes.drop(*self.first).join(least.hint("merge"), "label")
                           .select("node", "component_id", *self.first), "named")
        out = self.members.join(named.hint("merge"), "node", "left")
        return out.select("doc_id", F.col("n").alias("n_shingles"),
                          F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
                          .alias("component_id"), *(["node", "digest", *self.first] if self.first else []))


def at_of(column: str):
    """Number, from 1, of an id's bit in the map of wanted texts."""
    return F.pmod(F.xxhash64(column), F.lit(ID_SLOTS)) + 1


def checked(percent: int) -> int:
    if not 50 <= percent <= 100:
        raise ValueError("percent must be between 50 and 100")
    return percent


def similar_groups(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    return JaccardJoin(docs, size, checked(percent)).run()


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of similar documents, all columns kept.

    The row with the smallest id stays, a null id last; of rows that share the
    id the one with the smallest text digest, and one of rows that repeat both.
    Texts without an n-gram are in no group and all stay.
    """
    stage = Stager(docs.sparkSession)
    grouped = JaccardJoin(docs, size, checked(percent), digests=True).run().where("node IS NOT NULL")
    keep = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))
    verdicts = stage(grouped.groupBy("doc_id", "digest").agg(F.max(keep).alias("keep"), F.count(F.lit(1)).alias("n"))
                     .where("NOT keep OR n > 1").select("doc_id", "digest", "keep"), "verdicts")
    return keep_rows(docs, docs["doc_id"].cast("long"), content_hash(text_of(docs)), verdicts)
