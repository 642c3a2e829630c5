"""Comparing two builds of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _differs(left: Column, right: Column, tolerance: float | None) -> Column:
    if tolerance is None:
        return ~left.eqNullSafe(right)
    close = F.abs(left - right) <= F.lit(tolerance)
    return ~F.coalesce(close, left.isNull() & right.isNull())


def multiset_gap(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows one side holds more often than the other, nulls equal to nulls.

    For tables whose key repeats or that have none. One grouping with a map-side half.
    """
    signed = a.select(*columns, F.lit(1).alias("_side")).unionByName(b.select(*columns, F.lit(-1).alias("_side")))
    uses = signed.groupBy(*columns).agg(F.sum("_side").alias("_gap"))
    return uses.agg(F.coalesce(F.sum(F.abs("_gap")), F.lit(0)).alias("differing"))


def differences(
    a: DataFrame, b: DataFrame, keys: Sequence[str], tolerances: Mapping[str, float | None]
) -> DataFrame:
    """Rows missing on one side or unequal in any compared column.

    ``tolerances`` names the compared columns; ``None`` demands equality, null equal to null.
    Adds ``in_a``, ``in_b`` and one ``<column>_differs`` flag per column.
    """
    left = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in tolerances], F.lit(True).alias("in_a"))
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in tolerances], F.lit(True).alias("in_b"))
    joined = left.join(right, list(keys), "full_outer").withColumns(
        {"in_a": F.coalesce("in_a", F.lit(False)), "in_b": F.coalesce("in_b", F.lit(False))}
    )
    flagged = joined.withColumns(
        {
            f"{c}_differs": _differs(F.col(f"a_{c}"), F.col(f"b_{c}"), tolerance)
            for c, tolerance in tolerances.items()
        }
    )
    unequal = ~(F.col("in_a") & F.col("in_b"))
    for column in tolerances:
        unequal = unequal | F.col(f"{column}_differs")
    return flagged.where(unequal)


def reconciliation(
    a: DataFrame, b: DataFrame, keys: Sequence[str], tolerances: Mapping[str, float | None]
) -> DataFrame:
    """One row: how many keys differ, and how."""
    return differences(a, b, keys, tolerances).agg(
        F.count("*").alias("differing"),
        F.count_if(~F.col("in_b")).alias("only_in_a"),
        F.count_if(~F.col("in_a")).alias("only_in_b"),
        *[F.count_if(F.col(f"{c}_differs")).alias(f"{c}_differs") for c in tolerances],
    )


def overlap(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """Distinct values of a column in two row sets: only in a, only in b, in both."""
    left = a.select(value).where(F.col(value).isNotNull()).distinct().withColumn("in_a", F.lit(1))
    right = b.select(value).where(F.col(value).isNotNull()).distinct().withColumn("in_b", F.lit(1))
    return left.join(right, value, "full_outer").agg(
        F.count_if(F.col("in_b").isNull()).alias("only_first"),
        F.count_if(F.col("in_a").isNull()).alias("only_second"),
        F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNotNull()).alias("in_both"),
    )


def shared_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys present in both row sets; empty when the sets are disjoint."""
    return a.select(key).intersect(b.select(key))
