"""Raw CSV tables under a declared schema, landed as parquet with row-count reconciliation."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.contract import repeated_keys
from tidemark.sources.publish import publish_all, read_published
from tidemark.sources.tables import RawTables

TEXT, NTZ, INT = T.StringType(), T.TimestampNTZType(), T.IntegerType()
DOUBLE, MONEY = T.DoubleType(), T.DecimalType(10, 2)


@dataclass(frozen=True)
class TableSpec:
    """Columns in file order (name, type, required), and the key the rows must be unique on."""

    name: str
    columns: tuple[tuple[str, T.DataType, bool], ...]
    key: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, not required) for n, t, required in self.columns])

    @property
    def names(self) -> list[str]:
        return [name for name, _, _ in self.columns]

    @property
    def required(self) -> list[str]:
        return [name for name, _, required in self.columns if required]


# The nine raw tables, columns in file order -----------------------------------------

SPECS = (
    TableSpec(
        "orders",
        (
            ("order_id", TEXT, True),
            ("customer_id", TEXT, True),
            ("order_status", TEXT, True),
            ("order_purchase_timestamp", NTZ, True),
            ("order_approved_at", NTZ, False),
            ("order_delivered_carrier_date", NTZ, False),
            ("order_delivered_customer_date", NTZ, False),
            ("order_estimated_delivery_date", NTZ, True),
        ),
        ("order_id",),
    ),
    TableSpec(
        "customers",
        (
            ("customer_id", TEXT, True),
            ("customer_unique_id", TEXT, True),
            ("customer_zip_code_prefix", TEXT, True),
            ("customer_city", TEXT, True),
            ("customer_state", TEXT, True),
        ),
        ("customer_id",),
    ),
    TableSpec(
        "order_items",
        (
            ("order_id", TEXT, True),
            ("order_item_id", INT, True),
            ("product_id", TEXT, True),
            ("seller_id", TEXT, True),
            ("shipping_limit_date", NTZ, True),
            ("price", MONEY, True),
            ("freight_value", MONEY, True),
        ),
        ("order_id", "order_item_id"),
    ),
    TableSpec(
        "order_payments",
        (
            ("order_id", TEXT, True),
            ("payment_sequential", INT, True),
            ("payment_type", TEXT, True),
            ("payment_installments", INT, True),
            ("payment_value", MONEY, True),
        ),
        ("order_id", "payment_sequential"),
    ),
    TableSpec(
        "order_reviews",
        (
            ("review_id", TEXT, True),
            ("order_id", TEXT, True),
            ("review_score", INT, True),
            ("review_comment_title", TEXT, False),
            ("review_comment_message", TEXT, False),
            ("review_creation_date", NTZ, True),
            ("review_answer_timestamp", NTZ, True),
        ),
        ("review_id", "order_id"),
    ),
    TableSpec(
        "products",
        (
            ("product_id", TEXT, True),
            ("product_category_name", TEXT, False),
            ("product_name_lenght", INT, False),
            ("product_description_lenght", INT, False),
            ("product_photos_qty", INT, False),
            ("product_weight_g", INT, False),
            ("product_length_cm", INT, False),
            ("product_height_cm", INT, False),
            ("product_width_cm", INT, False),
        ),
        ("product_id",),
    ),
    TableSpec(
        "sellers",
        (
            ("seller_id", TEXT, True),
            ("seller_zip_code_prefix", TEXT, True),
            ("seller_city", TEXT, True),
            ("seller_state", TEXT, True),
        ),
        ("seller_id",),
    ),
    TableSpec(
        "geolocation",
        (
            ("geolocation_zip_code_prefix", TEXT, True),
            ("geolocation_lat", DOUBLE, True),
            ("geolocation_lng", DOUBLE, True),
            ("geolocation_city", TEXT, True),
            ("geolocation_state", TEXT, True),
        ),
    ),
    TableSpec(
        "product_category_name_translation",
        (
            ("product_category_name", TEXT, True),
            ("product_category_name_english", TEXT, True),
        ),
        ("product_category_name",),
    ),
)

# ------------------------------------------------------------------------------------------------

SPEC_BY_NAME = {spec.name: spec for spec in SPECS}

#: Attribute of the raw-table set -> table it is landed as.
ATTRIBUTES = {
    "orders": "orders",
    "customers": "customers",
    "items": "order_items",
    "payments": "order_payments",
    "reviews": "order_reviews",
    "products": "products",
    "sellers": "sellers",
    "geolocation": "geolocation",
    "translation": "product_category_name_translation",
}


class LandingError(ValueError):
    """A raw file or table is not what its spec declares."""


def csv_path(directory: str, table: str, template: str = "{table}.csv", files: Mapping[str, str] | None = None) -> str:
    """Where a table's file lies: a per-table name if given, else the name template."""
    name = (files or {}).get(table) or template.format(table=table)
    return f"{directory}/{name}"


def scan_csv(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Typed scan. Quoted newlines, doubled quotes and a byte-order mark are handled; an empty
    unquoted field is null; a header that differs in name or order fails the scan.

    Quoted newlines make a file unsplittable, so raw CSV is read once, to land it.
    """
    return (
        spark.read.schema(spec.schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def csv_header(spark: SparkSession, path: str) -> list[str]:
    columns = spark.read.option("header", True).csv(path).columns
    return [c.lstrip("﻿") for c in columns]


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def preflight(spark: SparkSession, directory: str, **naming) -> DataFrame:
    """(table, problem) of every missing or wrongly headed file; empty when all can be landed."""
    problems = []
    for spec in SPECS:
        path = csv_path(directory, spec.name, **naming)
        if not _exists(spark, path):
            problems.append((spec.name, "missing"))
            continue
        header = csv_header(spark, path)
        if not header:
            problems.append((spec.name, "empty"))
        elif header != spec.names:
            problems.append((spec.name, f"header {header} is not {spec.names}"))
    return spark.createDataFrame(problems, "table string, problem string")


def key_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """(table, rows, nulls in required columns, repeated keys) of one table."""
    nulls = F.lit(0).cast("bigint")
    for column in spec.required:
        nulls = nulls + F.count_if(F.col(column).isNull())
    counted = df.agg(F.count("*").alias("rows"), nulls.alias("required_nulls"))
    repeats = F.lit(0).cast("bigint")
    if spec.key:
        repeats = F.coalesce(
            repeated_keys(df, spec.key).agg(F.sum(F.col("n") - 1)).scalar(), F.lit(0).cast("bigint")
        )
    return counted.select(F.lit(spec.name).alias("table"), "rows", "required_nulls", repeats.alias("repeated_keys"))


def land(spark: SparkSession, directory: str, root: str, **naming) -> DataFrame:
    """Land all nine files, or none.

    Each file is written to parquet once; counts, nulls and keys are then checked on the parquet
    copy and against a parse of the file. Tables become visible together, after every check.
    Returns (table, read, inserted).
    """
    problems = preflight(spark, directory, **naming).collect()
    if problems:
        raise LandingError("; ".join(f"{p['table']}: {p['problem']}" for p in problems))
    scans = {s.name: scan_csv(spark, s, csv_path(directory, s.name, **naming)) for s in SPECS}
    report: list[tuple[str, int, int]] = []

    def check(written: Mapping[str, DataFrame]) -> None:
        for spec in SPECS:
            facts = key_report(written[spec.name], spec).first()
            read = scans[spec.name].count()
            report.append((spec.name, read, facts["rows"]))
            if read != facts["rows"]:
                raise LandingError(f"{spec.name}: {read} rows in the file, {facts['rows']} landed")
            if facts["required_nulls"] or facts["repeated_keys"]:
                raise LandingError(f"{spec.name}: {facts.asDict()}")

    publish_all(spark, root, scans, check=check)
    return spark.createDataFrame(report, "table string, read bigint, inserted bigint")


class LandedTables(RawTables):
    """The raw tables as last landed under a root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        for attribute, table in ATTRIBUTES.items():
            setattr(self, attribute, read_published(spark, root, table))
