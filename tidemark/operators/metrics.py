"""Ranking and calibration metrics over (label, score) frames.

Curves are built on one row per *distinct score*: a grouping with a map-side half, then running
counts over the sorted scores. Counts stay integers until the last division, so results do not
depend on the layout.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.quantiles import quantile_list
from tidemark.operators.ranking import global_rank, running_totals
from tidemark.session import materialize
from tidemark.settings import FN_FP_COST_RATIO, REVIEW_CAPACITY

LABEL, SCORE = "label", "score"


def score_frame(df: DataFrame, label: str | Column, score: str | Column, *keep: str) -> DataFrame:
    """(label int, score double) plus any columns that order ties."""
    lab = F.col(label) if isinstance(label, str) else label
    sco = F.col(score) if isinstance(score, str) else score
    return df.select(*keep, lab.cast("int").alias(LABEL), sco.cast("double").alias(SCORE))


def score_guards(df: DataFrame) -> DataFrame:
    """One row of what is wrong with a score frame, plus its sizes."""
    label, score = F.col(LABEL), F.col(SCORE)
    infinite = score.isin(float("inf"), float("-inf"))
    return df.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.when(label == 1, 1).otherwise(0)), F.lit(0)).alias("positives"),
        F.count_if(label.isNull() | ~label.isin(0, 1)).alias("bad_labels"),
        F.count_if(score.isNull() | F.isnan(score) | infinite).alias("bad_scores"),
        F.count_if((score < 0) | (score > 1)).alias("not_probabilities"),
    )


def require_scores(df: DataFrame, *, both_classes: bool = False, probabilities: bool = False) -> tuple[int, int]:
    """Rows and positives of a usable frame; raises on an unusable one."""
    row = score_guards(df).first()
    if row["n"] == 0:
        raise ValueError("no rows to score")
    if row["bad_labels"] or row["bad_scores"]:
        raise ValueError(f"labels must be 0/1 and scores finite: {row.asDict()}")
    if row["positives"] == 0 or (both_classes and row["positives"] == row["n"]):
        raise ValueError(f"the metric needs more than one class: {row.asDict()}")
    if probabilities and row["not_probabilities"]:
        raise ValueError(f"scores must be probabilities: {row.asDict()}")
    return row["n"], row["positives"]


def by_score(df: DataFrame) -> DataFrame:
    """Rows and positives per distinct score."""
    return df.groupBy(SCORE).agg(
        F.count("*").alias("n"), F.sum(F.col(LABEL).cast("bigint")).alias("pos")
    )


def ranking_curve(df: DataFrame) -> DataFrame:
    """Cumulative counts from the highest score down, one row per distinct score.

    ``tp``/``fp`` count rows scored at least ``score``; ``n``/``pos`` are the row's own.
    """
    counted = running_totals(by_score(df), [F.col(SCORE).desc()], {"n": "n", "pos": "pos"})
    return counted.select(
        SCORE,
        "n",
        "pos",
        F.col("pos_upto").alias("tp"),
        (F.col("n_upto") - F.col("pos_upto")).alias("fp"),
    )


def _total(curve: DataFrame, column: str) -> Column:
    """A whole-curve sum as a scalar subquery."""
    return curve.agg(F.sum(column)).scalar()


def areas(curve: DataFrame) -> DataFrame:
    """Average precision (step rule, ties as one step) and ROC area, from one curve."""
    tp, fp, pos, n = F.col("tp"), F.col("fp"), F.col("pos"), F.col("n")
    step = pos / (tp + fp) * tp
    trapezoid = (n - pos) * ((tp - pos) + pos / F.lit(2.0))
    sums = curve.agg(
        F.sum(step).alias("steps"),
        F.sum(trapezoid).alias("area"),
        F.sum("n").alias("rows"),
        F.sum("pos").alias("positives"),
    )
    positives = F.nullif(F.col("positives"), F.lit(0))
    negatives = F.nullif(F.col("rows") - F.col("positives"), F.lit(0))
    return sums.select(
        (F.col("steps") / positives).alias("pr_auc"),
        (F.col("area") / (positives.cast("double") * negatives)).alias("roc_auc"),
        "rows",
        "positives",
    )


def pr_auc(df: DataFrame) -> DataFrame:
    return areas(ranking_curve(df)).select("pr_auc")


def roc_auc(df: DataFrame) -> DataFrame:
    return areas(ranking_curve(df)).select("roc_auc")


def pr_auc_value(df: DataFrame) -> float:
    """Average precision as a number, for comparisons on the driver."""
    require_scores(df)
    return pr_auc(df).first()[0]


def pr_auc_by(df: DataFrame, group: str) -> DataFrame:
    """Average precision of many frames at once, told apart by the column ``group``.

    All of them share one global order and one set of jobs. Raises on labels or scores that
    :func:`pr_auc_value` would refuse.
    """
    label, score = F.col(LABEL), F.col(SCORE)
    bad = label.isNull() | ~label.isin(0, 1) | score.isNull() | F.isnan(score) | score.isin(float("inf"), float("-inf"))
    counts = df.groupBy(group, SCORE).agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(label.cast("bigint")), F.lit(0)).alias("pos"),
        F.count_if(bad).alias("bad"),
    )
    counted = running_totals(counts, [group, score.desc()], {"n": "n", "pos": "pos"})
    # One row a group.
    totals = counted.groupBy(group).agg(
        F.min("n_before").alias("_n"), F.min("pos_before").alias("_pos"), F.sum("pos").alias("_positives"), F.sum("bad").alias("_bad")
    )
    unusable = totals.where((F.col("_bad") > 0) | (F.col("_positives") == 0)).first()
    if unusable is not None:
        raise ValueError(f"labels must be 0/1 with a positive and scores finite: {unusable.asDict()}")
    tp, seen = F.col("pos_upto") - F.col("_pos"), F.col("n_upto") - F.col("_n")
    placed = counted.join(F.broadcast(totals), group)
    return placed.groupBy(group).agg((F.sum(F.col("pos") / seen * tp) / F.max("_positives")).alias("pr_auc"))


def brier(df: DataFrame) -> DataFrame:
    gap = F.col(SCORE) - F.col(LABEL)
    return df.agg(F.avg(gap * gap).alias("brier"))


def pr_points(curve: DataFrame) -> DataFrame:
    """Precision and recall at every distinct threshold."""
    return curve.select(
        F.col(SCORE).alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.nullif(_total(curve, "pos"), F.lit(0))).alias("recall"),
    )


def roc_points(curve: DataFrame) -> DataFrame:
    positives = _total(curve, "pos")
    return curve.select(
        F.col(SCORE).alias("threshold"),
        (F.col("fp") / F.nullif(_total(curve, "n") - positives, F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif(positives, F.lit(0))).alias("tpr"),
    )


def reviewed_count(n: int, capacity: float = REVIEW_CAPACITY) -> int:
    """How many rows a capacity reviews, rounded up in double arithmetic."""
    if not 0.0 < capacity <= 1.0:
        raise ValueError(f"capacity must lie in (0, 1], got {capacity}")
    return math.ceil(n * capacity)


def at_capacity(
    df: DataFrame, order: Sequence[str], capacity: float = REVIEW_CAPACITY, curve: DataFrame | None = None
) -> DataFrame:
    """Recall, precision and lift when only the top share of scores is reviewed.

    Whole score groups above the cut are read off the curve. Only the group the cut falls into is
    ordered row by row (by ``order``), and only if it is neither taken whole nor free of
    positives.
    """
    curve = ranking_curve(df) if curve is None else curve
    n, positives = curve.agg(F.sum("n"), F.sum("pos")).first()
    if not n:
        raise ValueError("no rows to review")
    k = reviewed_count(n, capacity)
    cut = (
        curve.where(F.col("tp") + F.col("fp") >= k)
        .agg(F.max(F.struct(SCORE, "n", "pos", "tp", "fp")).alias("g"))
        .first()["g"]
    )
    wanted = k - (cut["tp"] + cut["fp"] - cut["n"])
    if wanted == cut["n"] or cut["pos"] in (0, cut["n"]):
        in_group = cut["pos"] if wanted == cut["n"] else (wanted if cut["pos"] else 0)
    else:
        ties = df.where(F.col(SCORE) == F.lit(cut[SCORE])).select(*order, LABEL)
        taken = global_rank(ties, order).where(F.col("rank") < wanted)
        in_group = taken.agg(F.coalesce(F.sum(LABEL), F.lit(0))).first()[0]
    caught = cut["tp"] - cut["pos"] + in_group
    return df.sparkSession.createDataFrame(
        [
            (
                n,
                k,
                caught,
                caught / positives if positives else None,
                caught / k,
                (caught / k) / (positives / n) if positives else None,
            )
        ],
        "n bigint, reviewed bigint, caught bigint, recall_at_capacity double, "
        "precision_at_capacity double, lift_at_capacity double",
    )


def trivial_baseline(df: DataFrame) -> DataFrame:
    """Predict never late: how accurate, and how useless."""
    return df.agg(
        F.avg((F.col(LABEL) == 0).cast("int")).alias("accuracy"),
        F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("precision"),
        F.count("*").alias("n"),
    )


def summary(
    df: DataFrame, order: Sequence[str], capacity: float = REVIEW_CAPACITY
) -> DataFrame:
    """Every metric of one score frame in one row, sharing a single curve."""
    curve = materialize(ranking_curve(df))
    cap = at_capacity(df, order, capacity, curve).first()
    return areas(curve).select(
        "pr_auc",
        "roc_auc",
        brier(df).scalar().alias("brier"),
        *[
            F.lit(cap[name]).cast("double").alias(name)
            for name in ("recall_at_capacity", "precision_at_capacity", "lift_at_capacity")
        ],
        (F.col("positives") / F.col("rows")).alias("positive_rate"),
        F.lit(float(capacity)).alias("capacity"),
        F.col("rows").alias("n"),
    )


def confusion(df: DataFrame, threshold: float) -> DataFrame:
    """Counts at a threshold, with precision, recall and flag rate."""
    flagged, late = F.col(SCORE) >= F.lit(float(threshold)), F.col(LABEL) == 1
    counts = df.agg(
        F.count_if(flagged & late).alias("tp"),
        F.count_if(flagged & ~late).alias("fp"),
        F.count_if(~flagged & late).alias("fn"),
        F.count_if(~flagged & ~late).alias("tn"),
    )
    return with_rates(counts)


def with_rates(counts: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "precision": F.coalesce(tp / F.nullif(tp + fp, F.lit(0)), F.lit(0.0)),
            "recall": F.coalesce(tp / F.nullif(tp + fn, F.lit(0)), F.lit(0.0)),
            "flag_rate": (tp + fp) / F.nullif(tp + fp + fn + tn, F.lit(0)),
        }
    )


def confusion_shares(df: DataFrame, threshold: float) -> DataFrame:
    """The four cells as rows (actual, predicted, n, share)."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual_late"), F.lit(p).alias("predicted_late"), F.col(c).alias("n"))
            for c, a, p in (("tn", False, False), ("fp", False, True), ("fn", True, False), ("tp", True, True))
        ]
    )
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return (
        confusion(df, threshold)
        .select(total.alias("total"), F.inline(cells))
        .withColumn("share", F.col("n") / F.col("total"))
        .drop("total")
    )


def cost_curve(
    df: DataFrame, ratio: float = FN_FP_COST_RATIO, thresholds: Sequence[float] | None = None
) -> DataFrame:
    """Expected cost per row at every distinct score, or at given thresholds.

    At threshold t everything scored at least t is flagged: false positives are the curve's
    ``fp`` and misses are the positives it has not reached.
    """
    if ratio <= 0:
        raise ValueError(f"the cost ratio must be positive, got {ratio}")
    if thresholds is not None:
        return _cost_on_grid(df, ratio, thresholds)
    curve = ranking_curve(df)
    sized = curve.withColumns({"_rows": _total(curve, "n"), "_pos": _total(curve, "pos")})
    missed = F.col("_pos") - F.col("tp")
    return sized.select(
        F.col(SCORE).alias("threshold"),
        ((F.lit(float(ratio)) * missed + F.col("fp")) / F.col("_rows")).alias("cost"),
        "tp",
        "fp",
        missed.alias("fn"),
        (F.col("_rows") - F.col("_pos") - F.col("fp")).alias("tn"),
    )


def _cost_on_grid(df: DataFrame, ratio: float, thresholds: Sequence[float]) -> DataFrame:
    """Counts per grid interval, then a running sum over the (listed) thresholds."""
    grid = sorted(set(float(t) for t in thresholds))
    passed = F.size(F.filter(F.lit(grid), lambda t: t <= F.col(SCORE)))
    binned = df.groupBy(passed.alias("passed")).agg(
        F.count("*").alias("n"), F.sum(F.col(LABEL).cast("bigint")).alias("pos")
    )
    spark = df.sparkSession
    steps = spark.createDataFrame(list(enumerate(grid, start=1)), "passed int, threshold double")
    # One row per threshold.
    down = Window.orderBy(F.col("passed").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    merged = steps.join(binned, "passed", "full_outer").select(
        "passed",
        "threshold",
        F.sum(F.coalesce("n", F.lit(0))).over(down).alias("flagged"),
        F.sum(F.coalesce("pos", F.lit(0))).over(down).alias("tp"),
        F.sum("n").over(whole).alias("rows"),
        F.sum("pos").over(whole).alias("positives"),
    )
    fp, fn = F.col("flagged") - F.col("tp"), F.col("positives") - F.col("tp")
    return merged.where(F.col("threshold").isNotNull()).select(
        "threshold",
        ((F.lit(float(ratio)) * fn + fp) / F.col("rows")).alias("cost"),
        "tp",
        fp.alias("fp"),
        fn.alias("fn"),
        (F.col("rows") - F.col("positives") - fp).alias("tn"),
    )


def best_threshold(costs: DataFrame) -> DataFrame:
    """Cheapest threshold with its confusion counts; the lowest one on a tie."""
    best = costs.agg(F.min(F.struct("cost", "threshold", "tp", "fp", "fn", "tn")).alias("b"))
    return with_rates(best.select("b.threshold", "b.cost", "b.tp", "b.fp", "b.fn", "b.tn"))


def reliability(df: DataFrame, bins: int = 10) -> DataFrame:
    """Mean predicted and observed rate per equal-count bin; empty bins are absent."""
    edges = quantile_list(df, SCORE, [i / bins for i in range(1, bins)])
    bin_of = F.lit(0)
    for edge in edges:
        bin_of = bin_of + (F.col(SCORE) > F.lit(edge)).cast("int")
    return df.groupBy(bin_of.alias("bin")).agg(
        F.count("*").alias("n"),
        F.avg(SCORE).alias("mean_predicted"),
        F.avg(LABEL).alias("observed_rate"),
    )


def nearest_rank(durations: DataFrame, column: str, share: float = 0.95) -> float:
    """Nearest-rank percentile: the value at position int(n * share) - 1, never before the first."""
    n = durations.count()
    at = max(int(n * share) - 1, 0)
    counts = durations.groupBy(column).agg(F.count("*").alias("n"))
    upto = running_totals(counts, [column], {"n": "n"})
    return upto.where(F.col("n_upto") > at).agg(F.min(column)).first()[0]
