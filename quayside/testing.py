"""Test kit: key checks and an engine-neutral result comparison."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from quayside.sources.tables import DRIVER_TABLES


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (empty when the key is unique)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    dup = duplicate_keys(df, keys).limit(5).collect()
    if dup:
        raise AssertionError(f"duplicate keys {keys}: {dup}")


def _canon(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, float):
        return ("f", round(v, 6))
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("dt", v.isoformat())
    if isinstance(v, Row):
        return ("s", tuple(sorted((k, _canon(x)) for k, x in v.asDict().items())))
    if isinstance(v, dict):
        return ("s", tuple(sorted((str(k), _canon(x)) for k, x in v.items())))
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_canon(x) for x in v))
    return ("o", str(v))


def canonical(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    bag = Counter(tuple(_canon(r[i]) for i in order) for r in rows)
    return names, bag


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    con.execute("SET TimeZone = 'UTC'")
    return con


def compare(spark_df: DataFrame, sql: str, sf_dir: str, con=None) -> dict:
    """Run both sides and report row count, column names and value bags."""
    con = con or duck_connect(sf_dir)
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    s_cols = spark_df.columns
    s_rows = spark_df.collect()
    sn, sb = canonical(s_cols, s_rows)
    dn, db = canonical(d_cols, d_rows)
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows), "names_match": sn == dn,
           "values_match": sn == dn and sb == db}
    if not out["values_match"]:
        out["spark_cols"], out["oracle_cols"] = sn, dn
        out["only_spark"] = list((sb - db).items())[:3]
        out["only_oracle"] = list((db - sb).items())[:3]
    return out
