"""Command line: run one incremental or full run and exit with its verdict.

    python -m quayside incremental --root <folder> --catalog <parquet> \\
        --product-docs <json lines> --sales-docs <json lines> --calls <parquet> \\
        --as-of 2024-02-01T00:00:00 --version 20240201T000000

Exit code 1 when the run's verdict is ``fail`` (RPT-5), else 0. Targets are
``<root>/<staging prefix><table>`` and ``<root>/<production prefix><table>``.
The session is the one ``spark-submit`` provides; only the settings results
depend on are applied.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quayside.plans.runs import RunTargets, full_run, incremental_run
from quayside.session import prepare
from quayside.sinks import sales_layout
from quayside.sinks.publish import Target


def landed_lines(spark: SparkSession, path: str):
    """JSON lines with their order: file time, file name, block, then line within the block."""
    m = "_metadata."
    return spark.read.text(path).select(
        F.col(m + "file_modification_time").alias("file_time"), F.col(m + "file_path").alias("file"),
        F.col(m + "file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("doc"))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quayside")
    ap.add_argument("mode", choices=["incremental", "full"])
    ap.add_argument("--root", required=True)
    ap.add_argument("--staging-prefix", default="dev_")
    ap.add_argument("--production-prefix", default="prod_")
    ap.add_argument("--catalog", required=True, help="parquet with asin, product_visibility")
    ap.add_argument("--product-docs", required=True, help="landed product documents, one JSON per line")
    ap.add_argument("--sales-docs", required=True, help="landed sales documents, one JSON per line")
    ap.add_argument("--calls", help="parquet call log (event_id, ts, endpoint, status, n_items)")
    ap.add_argument("--as-of", required=True, help="run time, ISO format")
    ap.add_argument("--version", required=True, help="id of this run; repeating it is safe")
    ap.add_argument("--marketplace", default="us")
    ap.add_argument("--sales-buckets", type=int, default=sales_layout.BUCKETS, help="key buckets of the sales table")
    ap.add_argument("--sync-mode", default="fresh")
    ap.add_argument("--force-resync", action="store_true")
    ap.add_argument("--date-range", default="1month")
    ap.add_argument("--record-bad-rows", action="store_true", help="full run: record rejected points and go on")
    a = ap.parse_args(argv)

    spark = prepare(SparkSession.builder.appName(f"quayside-{a.mode}").getOrCreate())
    as_of = dt.datetime.fromisoformat(a.as_of)
    targets = RunTargets(Target(a.root, a.staging_prefix), Target(a.root, a.production_prefix), a.sales_buckets)
    catalog = spark.read.parquet(a.catalog)
    pdocs, sdocs = landed_lines(spark, a.product_docs), landed_lines(spark, a.sales_docs)
    if a.mode == "incremental":
        if not a.calls:
            ap.error("--calls is required for the incremental run")
        summary = incremental_run(spark, catalog, pdocs, sdocs, spark.read.parquet(a.calls), targets, as_of,
                                  a.version, a.marketplace).first()
        failed = summary.verdict == "fail"
    else:
        mode = "fresh" if a.force_resync else a.sync_mode
        summary = full_run(spark, catalog, pdocs, sdocs, targets, as_of, a.version, mode, a.date_range,
                           a.marketplace, calls=spark.read.parquet(a.calls) if a.calls else None,
                           strict=not a.record_bad_rows).first()
        failed = summary.failed > 0 and summary.product_ok == 0
    print(summary.asDict())
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
