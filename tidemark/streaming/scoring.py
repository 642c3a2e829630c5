"""Continuous scoring of order records: the same model, fed by a stream.

Every record is judged by the value rules; good ones are scored against the bundled snapshots,
bad ones are kept with their reasons. No state spans batches, so no watermark is needed. Each
output of a batch goes to a folder named by the batch, replaced if the batch is run again, so a
restart neither loses nor repeats a record.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.contract import Rule
from tidemark.operators.features import RAW_INPUTS
from tidemark.operators.scoring import ScoringModel, route_records
from tidemark.session import materialize

_TEXT = {
    "customer_state",
    "seller_state",
    "customer_zip_code_prefix",
    "route",
    "seller_id",
    "dominant_payment_type",
    "dominant_category",
}
_WHOLE = {
    "promised_days",
    "n_seller_states",
    "n_items",
    "n_distinct_products",
    "n_distinct_sellers",
    "max_installments",
    "n_payment_methods",
}


def _type_of(column: str) -> T.DataType:
    if column == "order_purchase_timestamp":
        return T.TimestampNTZType()
    if column in _TEXT:
        return T.StringType()
    return T.IntegerType() if column in _WHOLE else T.DoubleType()


def record_schema(key: str = "order_id") -> T.StructType:
    """Schema of a scoring record: a key and the raw inputs, nothing computed."""
    fields = [T.StructField(key, T.StringType())]
    return T.StructType(fields + [T.StructField(c, _type_of(c)) for c in RAW_INPUTS])


def conform(records: DataFrame, key: str = "order_id") -> DataFrame:
    """Cast a table of orders to the record schema."""
    return records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in record_schema(key)])


def read_records(
    spark: SparkSession, source: str, key: str = "order_id", files_per_batch: int = 10, fmt: str = "parquet"
) -> DataFrame:
    """A stream of records. The batch size is bounded by files, the unit a file source offers."""
    return (
        spark.readStream.format(fmt)
        .schema(record_schema(key))
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
    )


def score_stream(
    records: DataFrame,
    model: ScoringModel,
    root: str,
    key: str = "order_id",
    rules: Sequence[Rule] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start scoring ``records`` into ``root``: scored, rejected, unseen and durations."""

    def write(df: DataFrame, output: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{root}/{output}/batch={batch}")

    def handle(batch_df: DataFrame, batch: int) -> None:
        started = time.perf_counter()
        accepted, rejected = route_records(batch_df, rules)
        predictions, unseen = model.predict_with_report(materialize(accepted), [key])
        write(predictions, "scored", batch)
        write(rejected, "rejected", batch)
        write(unseen, "unseen", batch)
        millis = (time.perf_counter() - started) * 1000.0
        spark = batch_df.sparkSession
        write(spark.createDataFrame([(millis,)], "duration_ms double").coalesce(1), "durations", batch)

    writer = records.writeStream.foreachBatch(handle).option("checkpointLocation", f"{root}/_progress")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
