"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators depend on for correct results (not tuning).
REQUIRED_CONF = {
    # Every stamp is compared as wall-clock UTC; the driver tables carry
    # zone-less timestamps and the reference stores UTC.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts and decimal overflow must raise, as PostgreSQL does.
    "spark.sql.ansi.enabled": "true",
}

# Settings for scale: runtime re-planning of shuffles and skew.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(master: str = "local[8]", app: str = "quayside",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster, use the
    cluster's session and call :func:`prepare` on it instead."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**REQUIRED_CONF, **SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return prepare(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is used as is.
    Only a local master without it (tests) takes a fresh scratch folder.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d and not sc.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="quayside-ckpt-", dir=os.environ.get("QUAYSIDE_SCRATCH", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d
