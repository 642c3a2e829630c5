"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

#: SQL settings every job relies on. They are runtime settings, so they can be applied to a
#: session somebody else created.
SQL_DEFAULTS = {
    # NTZ columns carry local wall-clock time; the session zone only matters where Spark
    # widens them, and then it has to be fixed.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One key may hold a third of a table. Joins on raw keys (order, product, seller) are
    # left to the skew-join rule, and it may add a shuffle to split a hot partition.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SQL_DEFAULTS` to a running session and return it."""
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "tidemark", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark. Cluster jobs bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # Recording the Python line of every column expression costs more than planning it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    return configure(builder.getOrCreate())


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    else:
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach; "
            "a machine-local folder would be lost with its executor"
        )


def scratch_folder(spark: SparkSession) -> str:
    """A new folder on the shared checkpoint storage, for files a job hands to its next step."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


def materialize(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and continue from that table.

    ``by`` names a column with few values; each gets a folder, and readers of some open only those.

    Used where a frame is read more than once, or where it holds a physical fact
    (``spark_partition_id``) that has to become plain data before anything depends on it. A
    table rather than an RDD checkpoint: later reads take only the columns they need, and its
    measured size lets Spark decide for or against a broadcast.
    """
    folder = scratch_folder(df.sparkSession)
    (df.write.partitionBy(by) if by else df.write).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def materialize_parts(df: DataFrame, column: str, values: Iterable[str]) -> dict[str, DataFrame]:
    """Like :func:`materialize`, but one table for every value of ``column``, without that column.

    Each part has its own measured size, so a small one is broadcast however large the others are.
    """
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession)
    df.write.partitionBy(column).parquet(folder)
    files = spark.read.schema(df.schema).parquet(folder).inputFiles()
    schema = df.drop(column).schema
    parts = {}
    for value in values:
        own = [f for f in files if f"/{column}={value}/" in f]
        parts[value] = spark.read.schema(schema).parquet(*own) if own else spark.createDataFrame([], schema)
    return parts
