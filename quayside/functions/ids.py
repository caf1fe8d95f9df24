"""Key expressions over document ids (FLT-5, FLT-6, FLT-9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def asin_from_id(id_col: Column) -> Column:
    """FLT-5 (code path): ``<market>/<asin>`` gives the asin; an id with no
    slash or with more than one is taken whole."""
    parts = F.split(id_col, "/")
    return F.when(F.size(parts) == 2, F.element_at(parts, 2)).otherwise(id_col)


def id_marketplace(id_col: Column) -> Column:
    """FLT-6 (script path): text before the first slash (whole id if none)."""
    return F.split_part(id_col, F.lit("/"), F.lit(1))


def id_asin(id_col: Column) -> Column:
    """FLT-6 (script path): second slash-separated field; empty string when
    the id has no slash."""
    return F.split_part(id_col, F.lit("/"), F.lit(2))


def empty_to_null(c: Column) -> Column:
    """FLT-9: the sales path stores an empty parent key as NULL."""
    return F.nullif(c, F.lit(""))
