"""Staging vs production drift (JN-8).

Both copies are joined on the key with a full outer join; every other
column is compared null-safely (``<=>``). A row is ``only_staging``,
``only_production``, ``differs`` or ``same``.

:func:`drift_tree` finds the same rows without joining what is equal. Each side
is scanned once into digests by key bucket; the digests form a tree of a
root, ``FANOUT`` nodes and ``FANOUT`` leaves a node, compared from the root
down. Only rows of leaves that differ are shuffled and joined. Two copies that
agree cost one digest each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import ensure_checkpoint_dir

DRIFT_CLASSES = ("only_staging", "only_production", "differs", "same")


FANOUT = 256  # children of a digest node; the tree has FANOUT ** 2 leaves, so at most that many rows on the driver


def _leaf(keys: list[str]) -> Column:
    # As text, so that a key has one leaf whatever its column's type on either side.
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(FANOUT * FANOUT)).cast("int")


_MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
           "ignoreNullFields": "false"}


def _text(df: DataFrame, column: str) -> Column:
    """The value as text that differs wherever the value does; NULL for a column that the table lacks."""
    if column not in df.columns:
        return F.lit(None).cast("string")
    kind = df.schema[column].dataType
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(F.col(column), _MICROS)
    return F.col(column).cast("string")


def row_digests(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Digest of each leaf: row count, and exclusive or and sum of 60-bit row hashes, which partial sums combine. A row
    hash covers the keys and ``columns`` in their order, NULL included."""
    digest = F.md5(F.to_json(F.array(*[_text(df, c) for c in [*keys, *columns]])).cast("binary"))
    hashes = [F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint") for at in (1, 17)]
    return (df.select(_leaf(keys).alias("leaf"), hashes[0].alias("a"), hashes[1].alias("b")).groupBy("leaf")
            .agg(F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
                 F.sum(F.col("a").cast("decimal(38,0)")).alias("s")))


def _differing(sides: list[DataFrame], node: Column) -> list[int]:
    """The nodes whose digests differ; one row per node and side comes to the driver."""
    one, two = ({r.node: (r.n, r.a, r.b, r.s) for r in side.groupBy(node.alias("node")).agg(
        F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("s").alias("s")).collect()}
        for side in sides)
    return sorted(k for k in set(one) | set(two) if one.get(k) != two.get(k))


def differing_leaves(staging: DataFrame, production: DataFrame, keys: list[str]) -> list[int]:
    """The leaves whose digests differ, found from the root down: each level is read only below the nodes that differ
    on the level above."""
    ensure_checkpoint_dir(staging.sparkSession)
    columns = sorted((set(staging.columns) | set(production.columns)) - set(keys))
    sides = [row_digests(df, keys, columns).checkpoint(eager=True) for df in (staging, production)]
    if not _differing(sides, F.lit(0)):
        return []
    node = F.floor(F.col("leaf") / FANOUT).cast("int")
    nodes = _differing(sides, node)
    return _differing([side.where(node.isin(nodes)) for side in sides], F.col("leaf"))


def drift_tree(staging: DataFrame, production: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of :func:`drift_rows`; rows are joined only where the digests of their leaves differ."""
    leaves = differing_leaves(staging, production, keys)
    if not leaves:
        return drift_rows(staging.limit(0), production.limit(0), keys)
    # At most FANOUT ** 2 numbers, so the broadcast is bounded.
    found = F.broadcast(staging.sparkSession.createDataFrame([(leaf,) for leaf in leaves], "_leaf int"))

    def below(df: DataFrame) -> DataFrame:
        return df.join(found, _leaf(keys) == F.col("_leaf"), "left_semi")

    return drift_rows(below(staging), below(production), keys)


def drift_rows(staging: DataFrame, production: DataFrame, keys: list[str], keep_same: bool = False) -> DataFrame:
    """Keys whose rows differ. A column that only one side has counts as
    NULL on the other."""
    cols = [c for c in staging.columns if c not in keys]
    cols += [c for c in production.columns if c not in keys and c not in cols]

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(*keys, *[(F.col(c) if c in df.columns else F.lit(None)).alias(f"{mark}_{c}") for c in cols],
                         F.lit(True).alias(f"_{mark}"))

    s, p = side(staging, "s"), side(production, "p")
    j = s.join(p, keys, "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"s_{c}").eqNullSafe(F.col(f"p_{c}"))
    diff_cols = F.array_compact(F.array(*[F.when(~F.col(f"s_{c}").eqNullSafe(F.col(f"p_{c}")), F.lit(c))
                                          for c in cols]))
    cls = (F.when(F.col("_p").isNull(), "only_staging").when(F.col("_s").isNull(), "only_production")
           .when(same, "same").otherwise("differs"))
    out = j.select(*keys, cls.alias("drift"),
                   F.when(cls == "differs", F.concat_ws(",", diff_cols)).alias("changed_columns"))
    return out if keep_same else out.filter(F.col("drift") != "same")


def drift_summary(staging: DataFrame, production: DataFrame, keys: list[str]) -> DataFrame:
    rows = drift_rows(staging, production, keys, keep_same=True)
    return rows.agg(*[F.count_if(F.col("drift") == c).alias(c) for c in DRIFT_CLASSES])
