"""The command line runs one incremental run and exits with its verdict."""

import os
import subprocess
import sys
import tempfile

from quayside.session import ensure_checkpoint_dir
from quayside.sinks.publish import Target, live_paths, read_live
from quayside.sources import standin_docs as D
from quayside.sources import standins as S

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_incremental_run(spark, small_dir):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    os.makedirs(base, exist_ok=True)
    d = tempfile.mkdtemp(dir=base)
    S.catalog(spark, small_dir).write.parquet(f"{d}/catalog")
    D.product_documents(spark, small_dir).select("doc").write.text(f"{d}/pdocs")
    D.sales_documents(spark, small_dir).select("doc").write.text(f"{d}/sdocs")
    S.calls(spark, small_dir).write.parquet(f"{d}/calls")
    cmd = [sys.executable, "-m", "quayside", "incremental", "--root", f"{d}/tables", "--catalog", f"{d}/catalog",
           "--product-docs", f"{d}/pdocs", "--sales-docs", f"{d}/sdocs", "--calls", f"{d}/calls",
           "--as-of", "1999-06-01T00:00:00", "--version", "0001"]
    env = dict(os.environ, PYTHONPATH=REPO, PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.ui.enabled=false "
                                                                 "pyspark-shell")
    r = subprocess.run(cmd, cwd=REPO, env=env, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "'processed': 100" in r.stdout
    stg, prd = Target(f"{d}/tables", "dev_"), Target(f"{d}/tables", "prod_")
    assert read_live(spark, stg, "product_data").count() > 0
    assert live_paths(spark, prd, "sync_status") == []  # status is staging-only in the incremental run
