"""Reports about a matrix: nulls, unknown categories, correlations, drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import UNKNOWN
from tidemark.operators.asof import METRICS
from tidemark.operators.features import CATEGORICAL_SOURCES
from tidemark.settings import CATEGORY_CAP, ENTITIES


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, nulls, share) of every column, from one scan."""
    rows = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(columns)]
    )
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    return counts.select("_rows", F.inline(rows)).select(
        "feature", "nulls", (F.col("nulls") / F.nullif(F.col("_rows"), F.lit(0))).alias("share")
    )


def frequent_levels(df: DataFrame, column: str, k: int = CATEGORY_CAP) -> DataFrame:
    """The ``k`` most frequent values; equal counts are ordered by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), column).limit(k)


def level_coverage(df: DataFrame, column: str, k: int = CATEGORY_CAP) -> DataFrame:
    """Levels kept, levels present and the share of rows the kept ones cover."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    kept = counts.orderBy(F.col("n").desc(), column).limit(k)
    sizes = counts.agg(F.count("*").alias("present"), F.sum("n").alias("rows"))
    covered = kept.agg(F.struct(F.count("*").alias("kept"), F.sum("n").alias("covered"))).scalar()
    return sizes.withColumn("_k", covered).select(
        F.col("_k.kept").alias("kept"),
        "present",
        (F.col("_k.covered") / F.col("rows")).alias("coverage"),
    )


def unseen_categories(scored: DataFrame, sources: Mapping[str, str] = CATEGORICAL_SOURCES) -> DataFrame:
    """(feature, raw_value, rows) of raw values that fell through to the unknown level.

    ``scored`` carries each capped feature as ``<feature>`` and its raw source as
    ``raw_<source>``. One row per value rather than an array per feature, so a flood of new
    values is a longer table and not a larger row.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(feature).alias("feature"),
                F.when(F.col(feature) == UNKNOWN, F.col(f"raw_{source}").cast("string")).alias("raw_value"),
            )
            for feature, source in sources.items()
        ]
    )
    return (
        scored.select(F.inline(pairs))
        .where(F.col("raw_value").isNotNull())
        .groupBy("feature", "raw_value")
        .agg(F.count("*").alias("rows"))
    )


def correlations(df: DataFrame, pairs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """One row of Pearson correlations, from one scan."""
    return df.agg(*[F.corr(a.cast("double"), b.cast("double")).alias(n) for n, (a, b) in pairs.items()])


def history_columns() -> list[str]:
    return [f"{e.name}_{m}_hist" for e in ENTITIES for m in METRICS]


def history_drift(both: DataFrame, before: str) -> DataFrame:
    """How far history moves when the same orders read two different snapshots.

    ``both`` carries either reading, one under the history columns' own names and one with ``before``
    in front of them. Per history column: share of rows changed and mean absolute change where both
    are known.
    """
    names = history_columns()
    sides = both.select(
        *[F.col(f"{before}{c}").cast("double").alias(f"a_{c}") for c in names],
        *[F.col(c).cast("double").alias(f"b_{c}") for c in names],
    )
    aggregates = []
    for c in names:
        changed = ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
        aggregates += [
            F.avg(changed.cast("int")).alias(f"s_{c}"),
            F.avg(F.abs(F.col(f"a_{c}") - F.col(f"b_{c}"))).alias(f"m_{c}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"s_{c}").alias("share_changed"),
                F.col(f"m_{c}").alias("mean_abs_change"),
            )
            for c in names
        ]
    )
    return sides.agg(*aggregates).select(F.inline(rows))


def review_impact(outcomes: DataFrame, per_order: DataFrame) -> DataFrame:
    """Reviews of on-time against late orders. Analysis only; never a feature."""
    score = F.col("review_score")
    return (
        outcomes.select("order_id", "is_late")
        .join(per_order, "order_id", "left")
        .groupBy("is_late")
        .agg(
            F.count("*").alias("orders"),
            F.count("review_score").alias("with_review"),
            F.avg("review_score").alias("mean_review_score"),
            F.avg((score <= 2).cast("int")).alias("share_one_or_two"),
        )
    )


def review_gap(impact: DataFrame) -> DataFrame:
    """On-time minus late mean score, and how many orders have no review."""
    late = F.col("is_late")
    on_time_mean = F.max(F.when(~late, F.col("mean_review_score")))
    late_mean = F.max(F.when(late, F.col("mean_review_score")))
    return impact.agg(
        on_time_mean.alias("on_time_mean"),
        late_mean.alias("late_mean"),
        (on_time_mean - late_mean).alias("gap"),
        F.sum(F.col("orders") - F.col("with_review")).alias("reviews_missing"),
    )


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a hash of the key: the same rows under any layout."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key)))
    return df.orderBy(draw, key).limit(n)


def null_covering_example(df: DataFrame, columns: Sequence[str], key: str, n: int = 5) -> DataFrame:
    """``n`` rows that show a null in every column that has one, then the first rows by key.

    The smallest key with a null is found per column in one scan, so the second pass reads only
    as many keys as there are columns.
    """
    firsts = df.agg(
        *[F.min(F.when(F.col(c).isNull(), F.col(key))).alias(f"n{i}") for i, c in enumerate(columns)]
    ).first()
    shows_null = sorted({firsts[f"n{i}"] for i in range(len(columns))} - {None})
    wanted = F.col(key).isin(shows_null) if shows_null else F.lit(False)
    return df.withColumn("shows_null", wanted).orderBy(F.col("shows_null").desc(), key).limit(n)
