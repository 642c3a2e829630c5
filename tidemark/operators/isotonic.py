"""Isotonic regression of a 0/1 label on a score, pooled in slices and merged in a tree.

Distinct scores are cut into ranges. A range reduces to the blocks of its own isotonic fit, which
are the edges of the lower convex minorant of its cumulative counts: no vertex of the whole
minorant lies inside such an edge, so pooling the blocks of neighbouring ranges gives the blocks
of both. Ranges are merged ``FAN_IN`` at a time until one is left. A block is (lo, hi, n, pos) and
blocks are compared in integers, so the result does not depend on the cuts.

With 0/1 labels the block means are different fractions, so N rows have at most about N**(2/3)
blocks; that is what the last merge and the model hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.metrics import LABEL, SCORE, by_score, require_scores
from tidemark.session import materialize

FAN_IN = 16
_BLOCK = "lo double, hi double, n long, pos long"
_NAMES = ("lo", "hi", "n", "pos")

Block = tuple[float, float, int, int]


def pool(blocks: Iterable[Block]) -> list[Block]:
    """Blocks of the isotonic fit of blocks that are given in order of their scores."""
    out: list[Block] = []
    for lo, hi, n, pos in blocks:
        # Neighbours whose rates do not rise are one block.
        while out and out[-1][3] * n >= pos * out[-1][2]:
            first = out.pop()
            lo, n, pos = first[0], first[2] + n, first[3] + pos
        out.append((lo, hi, n, pos))
    return out


def _pool_table(table: pa.Table) -> pa.Table:
    table = table.sort_by("lo")
    found = pool(zip(*(table.column(c).to_pylist() for c in _NAMES), strict=True))
    columns = list(zip(*found, strict=True))
    group = pa.array([table.column("part")[0].as_py()] * len(found), pa.int64())
    kinds = (pa.float64(), pa.float64(), pa.int64(), pa.int64())
    return pa.table([group, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["part", *_NAMES])


def isotonic_blocks(scores: DataFrame, slices: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """lo, hi, n and pos of every block of the isotonic fit of (label, score)."""
    points = by_score(scores).select(F.col(SCORE).alias("lo"), F.col(SCORE).alias("hi"), "n", "pos")
    ranged = points.repartitionByRange(slices, "lo") if slices else points.repartitionByRange("lo")
    # The range number is physical, so it is written down before anything depends on it.
    parts = materialize(ranged.withColumn("part", F.spark_partition_id().cast("long")))
    width = (parts.agg(F.max("part")).first()[0] or 0) + 1
    schema = f"part long, {_BLOCK}"
    pooled = parts.groupBy("part").applyInArrow(_pool_table, schema)
    for _ in range(math.ceil(math.log(width, fan_in)) if width > 1 else 0):
        merged = materialize(pooled).withColumn("part", F.floor(F.col("part") / fan_in).cast("long"))
        pooled = merged.groupBy("part").applyInArrow(_pool_table, schema)
    return materialize(pooled.drop("part"))


def fit_isotonic(scores: DataFrame, slices: int | None = None) -> IsotonicRegressionModel:
    """Monotone map from score to observed rate, linear between blocks and clipped at both ends.

    The model is fitted to both ends of every block, which rise already, so nothing but blocks
    reaches the driver.
    """
    require_scores(scores)
    blocks = isotonic_blocks(scores, slices)
    rate = F.col("pos") / F.col("n")
    ends = F.array_distinct(F.array("lo", "hi"))
    points = blocks.select(F.explode(ends).alias(SCORE), rate.alias(LABEL), (F.col("n") / F.size(ends)).alias("weight"))
    return IsotonicRegression(
        featuresCol=SCORE, labelCol=LABEL, weightCol="weight", predictionCol="calibrated", isotonic=True
    ).fit(points)
