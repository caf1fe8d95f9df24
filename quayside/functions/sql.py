"""Rules of the engine as SQL functions of the session, for queries written as SQL text.

Each is a temporary function with a SQL body, so Catalyst inlines it: a query
that calls one is planned as if the body stood there, and runs without Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from quayside.functions.keys import ALPHABET

# Names, arguments and bodies. A NULL argument gives NULL.
FUNCTIONS = {
    # FLT-5: an id with exactly one slash gives what is behind it, any other id is taken whole.
    "qs_asin_from_id(id STRING) RETURNS STRING":
        "CASE WHEN size(split(id, '/')) = 2 THEN split_part(id, '/', 2) ELSE id END",
    # FLT-6: marketplace and key of an id; no slash gives the whole id and the empty text.
    "qs_id_marketplace(id STRING) RETURNS STRING": "split_part(id, '/', 1)",
    "qs_id_asin(id STRING) RETURNS STRING": "split_part(id, '/', 2)",
    # The calendar rule: fields are added, and what overflows the month runs into the next one.
    "qs_shift_date(d DATE, years INT, months INT, days INT) RETURNS DATE":
        "date_add(trunc(add_months(d, 12 * years + months), 'MM'), dayofmonth(d) - 1 + days)",
    # FLT-7: yyyy-MM-dd; anything else gives NULL.
    "qs_lenient_date(s STRING) RETURNS DATE": "CAST(try_to_timestamp(s, 'yyyy-MM-dd') AS DATE)",
    # KEY-1: a prefix character and n characters of the key's digests, 16 to a digest.
    "qs_surrogate_key(k STRING, prefix STRING, n INT) RETURNS STRING": f"""
        CASE WHEN k IS NOT NULL THEN concat(
            CASE WHEN length(prefix) = 1 THEN prefix ELSE 'x' END,
            array_join(transform(
                sequence(0, CASE WHEN n > 0 THEN n ELSE 8 END - 1),
                i -> substr('{ALPHABET}', CAST(conv(substr(
                    md5(CASE WHEN i < 16 THEN k ELSE concat(k, '#', CAST(i DIV 16 AS STRING)) END),
                    2 * (i % 16) + 1, 2), 16, 10) AS INT) % {len(ALPHABET)} + 1, 1)), '')) END""",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions in ``spark``'s session (again, if they are there); returns their names."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in FUNCTIONS]
