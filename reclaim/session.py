"""Spark session defaults for the engine.

On a cluster the session is created by the platform; ``configure`` only adds
SQL settings that the operators rely on (UTC dates, AQE).  Local sessions
(tests, bench) are built by ``local_session``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every operator assumes.  AQE re-plans joins at run time (broadcast
# when the measured side is small, split skewed partitions, coalesce tiny
# shuffle partitions); the session time zone pins date arithmetic.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # A table bucketed by customer_id joins by (customer_id, brand) as it is.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session
    without one gets a scratch folder of its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="reclaim-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


BROADCAST_ROWS = 10_000


def broadcast_if_small(df, rows: int = BROADCAST_ROWS):
    """``df`` with a broadcast hint if it has at most ``rows`` rows (counted;
    meant for written tables), else unchanged."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bounded(df, rows: int = BROADCAST_ROWS):
    """``df`` as a broadcast local frame if it has at most ``rows`` rows (read
    once, by one job), else unchanged."""
    from pyspark.sql import functions as F

    head = df.limit(rows + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(head, df.schema)) if len(head) <= rows else df


def materialize(df, name: str = "table", made: list[str] | None = None):
    """Write ``df`` as a Parquet table under the session's checkpoint folder
    and read it back: the lineage is cut, a lost executor costs a re-read
    rather than a recompute, and readers get column pruning and filter
    pushdown on the written table.  Its path is added to ``made``, for
    ``delete_tables``."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/reclaim-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    if made is not None:
        made.append(path)
    return spark.read.parquet(path)


HOT = 2  # times an even bucket's rows that one key may have


def materialize_by_key(df, name: str, key: str, made: list[str] | None = None, buckets: int | None = None):
    """``materialize`` bucketed and sorted by ``key``: tables written so, with
    one number of buckets (the session's shuffle partitions), join on the key
    without being shuffled again.

    A bucket is read by one task and cannot be split, so the keys are counted
    first: with a key of more than ``HOT`` even buckets' rows the table is
    written plain, and its joins are left to AQE's splitting."""
    import uuid

    from pyspark.sql import functions as F

    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    most, rows = df.groupBy(key).count().agg(F.max("count"), F.sum("count")).first()
    if n < 2 or (most or 0) * n > HOT * (rows or 0):
        return materialize(df, name, made)
    tag = uuid.uuid4().hex
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/reclaim-tables/{name}-{tag}"
    table = f"reclaim_{name}_{tag}"
    df.repartition(n, key).write.mode("overwrite").format("parquet").bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)
    if made is not None:
        made.append(path)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # external: the files and the frame stay
    return out


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``materialize`` wrote, by the cluster's own file
    system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "reclaim") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("RECLAIM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
