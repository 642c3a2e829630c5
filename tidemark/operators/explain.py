"""Attribution tables and the alarms read off them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Features expected to lead a ranking, and those whose lead is suspicious.
EXPECTED_LEADERS = ("promised_days", "seller_late_rate_hist", "haversine_km")
SUSPICIOUS_LEADERS = ("seller_late_rate_hist", "route_late_rate_hist")


def linear_attributions(
    df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float], keep: Sequence[str] = ()
) -> DataFrame:
    """Contribution of every input of a linear score: coefficient times distance from the mean."""
    return df.select(
        *keep,
        *[
            (F.lit(float(w)) * (F.col(c).cast("double") - F.lit(float(means[c])))).alias(c)
            for c, w in coefficients.items()
        ],
    )


def centred(contributions: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> tuple[DataFrame, float]:
    """Attributions as distance from each feature's mean contribution, and the sum of the means."""
    means = contributions.agg(*[F.avg(f).alias(f) for f in features]).first()
    out = contributions.select(*keep, *[(F.col(f) - F.lit(means[f])).alias(f) for f in features])
    return out, float(sum(means))


def blended_attributions(
    per_model: Mapping[str, DataFrame], weights: Mapping[str, float], key: str, features: Sequence[str]
) -> DataFrame:
    """Weighted average of per-model attributions of the same rows."""
    if set(per_model) != set(weights):
        raise KeyError(f"models {sorted(per_model)} do not match weights {sorted(weights)}")
    names = sorted(per_model)
    joined = None
    for name in names:
        part = per_model[name].select(key, *[F.col(f).alias(f"{name}__{f}") for f in features])
        joined = part if joined is None else joined.join(part, key)

    def average(feature: str) -> Column:
        total = F.lit(0.0)
        for name in names:
            total = total + F.lit(float(weights[name])) * F.col(f"{name}__{feature}")
        return total.alias(feature)

    return joined.select(key, *[average(f) for f in features])


def mean_abs_attribution(attributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, importance), one row per feature, from one scan."""
    means = attributions.agg(*[F.avg(F.abs(F.col(f))).alias(f) for f in features])
    return means.unpivot([], list(features), "feature", "importance")


def leaders(ranking: DataFrame, n: int) -> DataFrame:
    return ranking.orderBy(F.col("importance").desc(), "feature").limit(n)


def additivity_gap(attributions: DataFrame, features: Sequence[str], base: float, output: str) -> DataFrame:
    """Largest distance between base plus attributions and the model's own output."""
    total = F.lit(float(base))
    for feature in features:
        total = total + F.col(feature)
    return attributions.agg(F.max(F.abs(total - F.col(output))).alias("additivity_gap"))


def leakage_alarms(ranking: DataFrame, n: int = 3) -> DataFrame:
    """(feature, alarm): suspicious leaders, and one row if no expected leader leads."""
    top = leaders(ranking, n)
    suspicious = top.where(F.col("feature").isin(*SUSPICIOUS_LEADERS)).select(
        "feature", F.lit("dominates although it cannot legitimately").alias("alarm")
    )
    expected = top.agg(F.count_if(F.col("feature").isin(*EXPECTED_LEADERS)).alias("n"))
    missing = expected.where(F.col("n") == 0).select(
        F.lit("*").alias("feature"), F.lit("no expected feature leads").alias("alarm")
    )
    return suspicious.unionByName(missing)
