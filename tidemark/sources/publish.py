"""All-or-nothing publication of derived tables.

Every run writes its tables into a folder of its own. They become visible by one append to a
publications log, after all of them were written and checked; readers follow the newest entry.
Nothing visible is ever overwritten, so a job lost half-way leaves the last good tables in place,
and running it again replaces them whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "_publications"
LOG_SCHEMA = "table string, path string, published_at timestamp_ntz, run string"


def publish_all(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, DataFrame],
    *,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    check: Callable[[Mapping[str, DataFrame]], None] | None = None,
) -> dict[str, DataFrame]:
    """Write, check, then show. ``check`` sees the written tables and raises to hold them back."""
    run = uuid.uuid4().hex
    paths = {name: f"{root}/{name}/run={run}" for name in tables}
    for name, df in tables.items():
        writer = df.write.mode("error")
        columns = (partition_by or {}).get(name)
        if columns:
            writer = writer.partitionBy(*columns)
        writer.parquet(paths[name])
    written = {name: spark.read.parquet(path) for name, path in paths.items()}
    if check is not None:
        check(written)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    entries = [(name, path, now, run) for name, path in paths.items()]
    log = spark.createDataFrame(entries, LOG_SCHEMA).coalesce(1)
    log.write.mode("append").parquet(f"{root}/{LOG}")
    return written


def published_path(spark: SparkSession, root: str, table: str) -> str:
    try:
        log = spark.read.schema(LOG_SCHEMA).parquet(f"{root}/{LOG}")
    except AnalysisException as missing:
        raise LookupError(f"nothing has been published under {root}") from missing
    row = log.where(F.col("table") == table).agg(
        F.max_by("path", F.struct("published_at", "run")).alias("path")
    ).first()
    if row["path"] is None:
        raise LookupError(f"{table} has not been published under {root}")
    return row["path"]


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(published_path(spark, root, table))


def append_rows(df: DataFrame, root: str, table: str) -> None:
    """Append to a log table; used for decisions and version events."""
    df.write.mode("append").parquet(f"{root}/{table}")


def read_log(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """A log table, or no rows if nothing was ever appended."""
    try:
        return spark.read.schema(schema).parquet(f"{root}/{table}")
    except AnalysisException:
        return spark.createDataFrame([], schema)
