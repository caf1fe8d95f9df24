"""Staged publishing to two targets through pointer tables (SRC-4/5, SNK-1..5).

A *target* is a root folder plus a table-name prefix (``dev_``, ``prod_``).
A table is a set of immutable folders plus numbered pointers. Every write,
also a retry or a rerun of the same version id, gets a folder of its own
(``table_version=<version>-<unique>``) and never touches a published one. The pointer is
the only commit: ``_pointers/n=<number>`` lists the live folders, its number
is one above every number ever used, and it is written to a folder that must
not exist yet. Readers take the highest committed number, so the text of a
version id has no say in what is live.

Staging is written first, from the plan; production only if staging
succeeded, and it is copied from the staging files (the upstream plan is not
computed twice). Production gets up to three attempts, pausing 1 s, then 2 s.

Partitioned tables can publish only the partitions a change touched: the
pointer then lists the folders of each partition value, keeps the old folders of
the others, and drops a replaced partition that ended up empty. Rows of new keys
can be added to a partition as one more folder, without a rewrite of the others.

After a commit, pointers older than the newest ``KEEP_POINTERS`` and folders
that no kept pointer names are removed. One writer per table at a time (the
reference serialises its runs with a process-wide lock; a scheduler does the
same here).
"""

from __future__ import annotations

import logging
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

POINTER = "_pointers"
LEVEL = "table_version"  # folder level of the writes; no column of a table may have this name
POINTER_SCHEMA = T.StructType([T.StructField("version", T.StringType()),
                               T.StructField("table_name", T.StringType()),
                               T.StructField("part_value", T.StringType())])
PRODUCTION_ATTEMPTS = 3
KEEP_POINTERS = 10


@dataclass(frozen=True)
class Target:
    """Where a table lives: ``<root>/<prefix><name>`` (SRC-5)."""
    root: str
    prefix: str = ""

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.prefix}{name}"


def _folder(spark: SparkSession, path: str):
    """Hadoop file system and path of a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)


def _names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)]


def _pointer_numbers(spark: SparkSession, target: Target, name: str) -> list[int]:
    """Numbers of all pointers, also unfinished ones, newest first."""
    return sorted((int(n[2:]) for n in _names(spark, f"{target.table(name)}/{POINTER}", "n=")), reverse=True)


def _pointer_path(target: Target, name: str, number: int) -> str:
    return f"{target.table(name)}/{POINTER}/n={number:012d}"


def _committed(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def live_pointer(spark: SparkSession, target: Target, name: str) -> DataFrame | None:
    """Rows of the newest committed pointer (None if the table does not
    exist). Unfinished ones above it are skipped; older ones are not looked at."""
    for number in _pointer_numbers(spark, target, name):
        path = _pointer_path(target, name, number)
        if _committed(spark, path):
            return spark.read.schema(POINTER_SCHEMA).parquet(path)
    return None


def committed_versions(spark: SparkSession, target: Target, name: str) -> set[str]:
    """Version ids of the kept pointers."""
    paths = [p for p in (_pointer_path(target, name, n) for n in _pointer_numbers(spark, target, name))
             if _committed(spark, p)]
    if not paths:
        return set()
    return {r.version for r in spark.read.schema(POINTER_SCHEMA).parquet(*paths).select("version").distinct().collect()}


def live_paths(spark: SparkSession, target: Target, name: str) -> list[str]:
    """SRC-4: the folders the pointer names. The pointer holds one row per
    partition at most (bounded by the partition count), so it is read to the
    driver; an unpartitioned table has exactly one row (first row wins)."""
    p = live_pointer(spark, target, name)
    if p is None:
        return []
    return [r.table_name for r in p.select("table_name").distinct().orderBy("table_name").collect()]


def read_live(spark: SparkSession, target: Target, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a table through its pointer. Partition folders may come from
    different versions; partition discovery runs from the table root, and
    the version level is dropped."""
    paths = live_paths(spark, target, name)
    if not paths:
        if schema is None:
            raise FileNotFoundError(f"no live version of {target.table(name)}")
        return spark.createDataFrame([], schema)
    if "=" in paths[0].rsplit("/", 1)[-1] and paths[0].rsplit("/", 2)[-2].startswith(f"{LEVEL}="):
        df = spark.read.option("basePath", target.table(name)).parquet(*paths).drop(LEVEL)
    else:
        df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(*paths)
    if schema is None:
        return df
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _write_pointer(spark: SparkSession, target: Target, name: str, version: str,
                   rows: list[tuple[str, str | None]]) -> None:
    number = max(_pointer_numbers(spark, target, name), default=0) + 1
    df = spark.createDataFrame([(version, p, v) for p, v in rows], POINTER_SCHEMA)
    df.coalesce(1).write.mode("error").parquet(_pointer_path(target, name, number))


def write_version(df: DataFrame, target: Target, name: str, version: str,
                  partition_by: str | None = None) -> str:
    """Write one immutable folder, unique to this attempt.

    A partitioned write is first rebalanced on the partition column, so each
    partition value is written by few tasks (few, large files); AQE splits a
    hot partition value over several tasks instead of one."""
    path = f"{target.table(name)}/{LEVEL}={version}-{uuid.uuid4().hex[:12]}"
    if partition_by:
        df = df.hint("rebalance", partition_by)
    w = df.write.mode("error")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def _pointer_rows(spark: SparkSession, target: Target, name: str, path: str, partition_by: str | None,
                  merge_partitions: bool, replaced: set[str] | None,
                  beside: list[tuple[str, str]] | None = None) -> list[tuple[str, str | None]]:
    if not partition_by:
        return [(path, None)]
    rows = [(f"{path}/{n}", n.split("=", 1)[1]) for n in _names(spark, path, f"{partition_by}=")]
    if beside is not None:
        rows += beside
    elif merge_partitions:
        gone = {v for _, v in rows} | (replaced or set())
        rows += [r for r in live_folders(spark, target, name) if r[1] not in gone]
    if not rows:  # an empty table: the (empty) version folder itself
        return [(path, None)]
    return sorted(rows, key=lambda r: (r[1], r[0]))


def live_folders(spark: SparkSession, target: Target, name: str) -> list[tuple[str, str]]:
    """(folder, partition value) of a partitioned table's pointer; a value that was added to has several folders."""
    live = live_pointer(spark, target, name)
    return [(r.table_name, r.part_value) for r in (live.collect() if live is not None else []) if r.part_value is not None]


def publish_one(df: DataFrame, target: Target, name: str, version: str, partition_by: str | None = None,
                merge_partitions: bool = False, replaced: set[str] | None = None,
                beside: list[tuple[str, str]] | None = None) -> str:
    """Write a version and switch the pointer to it. ``replaced`` names the
    partition values this write replaces, also where it has no row for them.
    ``beside`` (folder, partition value) are the folders that stay live beside
    what is written, also those of the same values."""
    spark = df.sparkSession
    path = write_version(df, target, name, version, partition_by)
    rows = _pointer_rows(spark, target, name, path, partition_by, merge_partitions, replaced, beside)
    _write_pointer(spark, target, name, version, rows)
    prune(spark, target, name, protect=path)
    return path


def prune(spark: SparkSession, target: Target, name: str, keep: int = KEEP_POINTERS, protect: str = "") -> None:
    """Remove pointers older than the newest ``keep`` committed ones, and folders none of the kept ones names.
    ``protect`` is a folder that stays: a write without rows is named by no pointer, but still copied from."""
    table = target.table(name)
    numbers = _pointer_numbers(spark, target, name)
    kept = [n for n in numbers if _committed(spark, _pointer_path(target, name, n))][:keep]
    if not kept:
        return
    paths = [_pointer_path(target, name, n) for n in kept]
    named = {r.table_name for r in spark.read.schema(POINTER_SCHEMA).parquet(*paths).select("table_name").distinct().collect()}
    used = {part for path in [*named, protect] for part in path.split("/") if part.startswith(f"{LEVEL}=")}
    for old in [_pointer_path(target, name, n) for n in numbers if n < min(kept)] + \
            [f"{table}/{v}" for v in _names(spark, table, f"{LEVEL}=") if v not in used]:
        drop_folder(spark, old)


def publish(df: DataFrame, name: str, version: str, staging: Target, production: Target | None = None,
            attempts: int = PRODUCTION_ATTEMPTS, partition_by: str | None = None,
            merge_partitions: bool = False, on_error: str = "raise", pause_s: float = 1.0,
            replaced: set[str] | None = None, once: bool = False, added: bool = False) -> DataFrame:
    """SNK-1: staging first; production only after staging succeeded,
    copied from the staging files, with retries. ``on_error='log'``
    (SNK-3) records failures in the report instead of raising. ``once``
    (unpartitioned tables) skips a target that has this version already, for
    changes that must not be applied twice when a run is repeated. ``added``
    (partitioned tables) writes rows whose keys no target holds: every live
    folder stays, also those of the partitions written to, and none is read.
    Returns a report ``(table, target, version, status, attempts, error)``."""
    spark = df.sparkSession
    report = []
    try:
        if once and version in committed_versions(spark, staging, name):
            if production is None or version in committed_versions(spark, production, name):
                return _report(spark, [(name, staging.prefix, version, "skipped", 0, None)])
            (spath,) = live_paths(spark, staging, name)
        else:
            beside = live_folders(spark, staging, name) if added else None
            spath = publish_one(df, staging, name, version, partition_by, merge_partitions, replaced, beside)
        report.append((name, staging.prefix, version, "ok", 1, None))
    except Exception as e:  # staging failed: production is not attempted
        if on_error != "log":
            raise
        log.warning("staging publish of %s failed: %s", name, e)
        report.append((name, staging.prefix, version, "failed", 1, str(e)[:500]))
        return _report(spark, report)
    if production is not None:
        # Copy of the staging files (with the plan's schema, so an empty
        # version needs no inference); partition columns go back in place.
        copy = spark.read.schema(df.schema).parquet(spath).select(*df.columns)
        last = None
        # Listed once: a retry after an attempt that did commit must not keep that attempt's folder too.
        beside = live_folders(spark, production, name) if added else None
        for attempt in range(1, attempts + 1):
            try:
                publish_one(copy, production, name, version, partition_by, merge_partitions, replaced, beside)
                report.append((name, production.prefix, version, "ok", attempt, None))
                last = None
                break
            except Exception as e:
                last = e
                if attempt < attempts:
                    time.sleep(pause_s * attempt)
        if last is not None:
            if on_error != "log":
                raise last
            report.append((name, production.prefix, version, "failed", attempts, str(last)[:500]))
    return _report(spark, report)


def _report(spark: SparkSession, rows) -> DataFrame:
    schema = "table string, target string, version string, status string, attempts int, error string"
    return spark.createDataFrame(rows, schema)


# SNK-2: which tables each run writes to which targets.
RUN_TARGETS = {
    "incremental": {"product_data": ("staging", "production"), "sales_estimate_data": ("staging", "production"),
                    "sync_status": ("staging",), "api_usage": ("staging", "production"),
                    "run_rejects": ("staging",)},
    "full": {"product_data": ("staging", "production"), "sales_estimate_data": ("staging", "production"),
             "sync_status": ("staging", "production"), "api_usage": ("staging", "production"),
             "run_rejects": ("staging",)},
    "adhoc": {"product_data": ("staging", "production"), "sales_estimate_data": ("staging", "production")},
}


def ensure_table(spark: SparkSession, target: Target, name: str, schema: T.StructType,
                 version: str = "0") -> bool:
    """SNK-5: create an empty table once (defaults are applied by writers).
    Returns True when it was created."""
    if live_pointer(spark, target, name) is not None:
        return False
    publish_one(spark.createDataFrame([], schema), target, name, version)
    return True
