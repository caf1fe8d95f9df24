"""Surrogate keys without collisions (KEY-1..3).

A key drawn from a digest is as good as random, so short keys of many rows
collide. Here a drawn value goes to the smallest natural key that draws it;
the others draw again, salted with the number of the round, until every key
has a value of its own. Keys that already have one keep it (``existing``), and
no new key can take it. The result is a function of the keys and ``existing``
alone: a repeated run gives the same values.

A fixed length has room for only so many keys. Where the caller can draw longer
values too (``longer``), a round of many keys of which less than half get a
value is taken as a sign that the space is filling up, and the keys that are
left draw one character more from then on. Keys that have a value keep it.

Scale: the first round shuffles the keys once by value and once by key; later
rounds hold only the keys that collided, a share that shrinks by round. Sums
are partial, so many keys that draw one value make no large group. The joins
are shuffled: the sides grow with the keys, and none is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import ensure_checkpoint_dir

MAX_ROUNDS = 64
CROWD = 1000  # keys from which a round says something about how full the space is


class KeySpaceFull(ValueError):
    pass


def unique_keys(keys: DataFrame, key: str, out: str, draw: Callable[[Column], Column],
                existing: DataFrame | None = None, longer: Callable[[Column, int], Column] | None = None) -> DataFrame:
    """(``key``, ``out``): one row per distinct natural key that is not NULL, and those of ``existing``.

    ``draw`` gives the value of a (salted) natural key, for example
    ``lambda k: surrogate_key(k, "p")``. ``longer`` gives a value that is so
    many characters longer, for example ``lambda k, n: surrogate_key(k, "p", 8
    + n)``; without it the length stays. Raises ``KeySpaceFull`` if keys are
    still without a value after ``MAX_ROUNDS`` rounds."""
    ensure_checkpoint_dir(keys.sparkSession)
    wanted = keys.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct()
    taken = wanted.limit(0).withColumn(out, F.lit(None).cast("string"))
    if existing is not None:
        taken = existing.select(F.col(key).cast("string").alias(key), F.col(out).cast("string").alias(out))
    todo, extra = wanted.join(taken.select(key).hint("merge"), key, "left_anti"), 0
    for salt in range(MAX_ROUNDS):
        salted = F.col(key) if salt == 0 else F.concat(key, F.lit(f"~{salt}"))
        drawn = todo.withColumn(out, longer(salted, extra) if extra else draw(salted)).checkpoint(eager=True)
        won = (drawn.groupBy(out).agg(F.min(key).alias(key)).join(taken.select(out).hint("merge"), out, "left_anti")
               .select(key, out).checkpoint(eager=True))
        taken = taken.unionByName(won)
        todo = drawn.select(key).join(won.select(key).hint("merge"), key, "left_anti")
        n = drawn.count()
        left = n - won.count()  # each key that won is one row of both
        if not left:
            return taken
        if longer is not None and n >= CROWD and 2 * left > n:
            extra += 1
    raise KeySpaceFull(f"keys are left without a value after {MAX_ROUNDS} rounds; use longer keys")


def duplicate_values(table: DataFrame, out: str) -> DataFrame:
    """The uniqueness check: values that more than one row has."""
    return table.groupBy(out).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
