"""Chunked bulk writes to a relational target (UPS-7).

The reference writes sales rows 100 per multi-row INSERT. Spark's JDBC
writer batches on its own; ``batch_size`` sets the rows per batch, and the
partition count bounds the concurrent connections (the reference's pool
allows 25 per database). Upsert semantics are computed in Spark first
(``quayside.operators.upsert``), so the relational side only receives the
rows to write for the touched keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS_PER_STATEMENT = 100   # fixed value of the reference
MAX_CONNECTIONS = 25       # fixed value of the reference (open connections per database)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "append", batch_size: int = ROWS_PER_STATEMENT,
               max_connections: int = MAX_CONNECTIONS) -> None:
    """Write ``df`` to ``table`` in batches of ``batch_size`` rows over at
    most ``max_connections`` connections. The rows are dealt anew for that, so
    the plan that makes them keeps its own parallelism."""
    w = (df.repartition(max_connections).write.mode(mode).format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)).option("numPartitions", str(max_connections)))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
