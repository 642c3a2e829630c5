"""Running totals and ranks over a global order, without a single-task window.

``Window.orderBy`` with no partition pulls a table into one task, and bucketing by date or by
rounded score leaves a hot bucket just as large. Here Spark's own range partitioner cuts the
order into slices of similar size (ties on the leading column are split by the later ones), the
slice number is written down as data, each slice is summed on its own, and the slice offsets, one
row per slice, are added back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

SLICE = "_slice"


def running_totals(
    df: DataFrame, order: Sequence[str | Column], sums: Mapping[str, Column | str]
) -> DataFrame:
    """Add ``<name>_before`` and ``<name>_upto`` for every entry of ``sums``.

    ``order`` should identify rows uniquely; equal keys would be summed in an arbitrary order.
    ``_before`` excludes the row itself, ``_upto`` includes it. Summands must not be null.
    """
    keys = [F.col(key) if isinstance(key, str) else key for key in order]
    fields = {f"_add_{name}": value for name, value in sums.items()}
    prepared = df.select(
        "*", *[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]
    )
    # The slice number is physical. It is written to the checkpoint folder before anything
    # depends on it, so a lost executor cannot renumber rows already counted.
    sliced = materialize(
        prepared.repartitionByRange(*keys).withColumn(SLICE, F.spark_partition_id())
    )

    # One row per slice: a window over it is bounded by the number of slices.
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy(SLICE).agg(*[F.sum(k).alias(k) for k in fields]).select(
        SLICE, *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"{k}_offset") for k in fields]
    )

    within = (
        Window.partitionBy(SLICE).orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = sliced.join(F.broadcast(offsets), SLICE)
    for name in sums:
        out = out.withColumn(
            f"{name}_upto", F.sum(f"_add_{name}").over(within) + F.col(f"_add_{name}_offset")
        )
    for name in sums:
        out = out.withColumn(f"{name}_before", F.col(f"{name}_upto") - F.col(f"_add_{name}"))
    return out.drop(SLICE, *fields, *[f"{k}_offset" for k in fields])


#: ``monotonically_increasing_id`` keeps the position within a partition in its lower bits.
_POSITION_BITS = 33


def global_rank(df: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """Zero-based position of every row in the global order.

    A slice is sorted where the range partitioner puts it, so a row's place in it is known without
    moving the rows a second time. Slice and place are written down together, as in
    :func:`running_totals`.
    """
    keys = [F.col(key) if isinstance(key, str) else key for key in order]
    placed = materialize(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    sliced = placed.select("*", F.shiftright("_place", _POSITION_BITS).alias(SLICE))

    # One row per slice: a window over it is bounded by the number of slices.
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy(SLICE).agg(F.count("*").alias("_n")).select(
        SLICE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    return sliced.join(F.broadcast(offsets), SLICE).select(*df.columns, (within + F.col("_offset")).alias(name))


def dominant(
    df: DataFrame, groups: Sequence[str], member: str, weight: Column, name: str
) -> DataFrame:
    """Member with the largest summed weight per group; ties go to the smallest member.

    Summed per (group, member) first, so a hot group arrives at its task already reduced to one
    row per member, and the pick itself is an aggregate with a map-side half.
    """
    shares = df.where(F.col(member).isNotNull()).groupBy(*groups, member).agg(weight.alias("_w"))
    return shares.groupBy(*groups).agg(
        F.min(F.struct((-F.col("_w")).alias("w"), F.col(member).alias("m")))["m"].alias(name)
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of an order (a bounded heap per task, merged at the end)."""
    return df.orderBy(*order).limit(k)
