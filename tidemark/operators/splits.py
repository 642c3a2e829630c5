"""Windows over time: selection, folds, halves, ordering checks, the locked window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import ntz
from tidemark.operators.population import within
from tidemark.operators.ranking import global_rank
from tidemark.settings import CV_FOLDS, EARLY_STOPPING_TAIL, PURCHASED_AT, Calendar, DateWindow, EvaluationLocked, SealedWindow

TOTAL_ORDER = (PURCHASED_AT, "order_id")


def select_window(df: DataFrame, window: DateWindow, column: str = PURCHASED_AT) -> DataFrame:
    """Rows of one window. A partition column ``purchase_month`` is pruned as well."""
    if isinstance(window, SealedWindow):
        raise EvaluationLocked("a sealed window is selected by evaluation_rows")
    if column not in df.columns:
        raise KeyError(f"{column!r} is not a column; cannot select {window.name}")
    rows = df.where(within(window, column))
    if column == PURCHASED_AT and "purchase_month" in df.columns:
        first = ntz(window.start.replace(day=1))
        rows = rows.where((F.col("purchase_month") >= first) & (F.col("purchase_month") < ntz(window.stop)))
    return rows


def window_label(calendar: Calendar, reader: str, column: str = PURCHASED_AT) -> Column:
    """Array of the names of all windows a row falls in (versions overlap)."""
    return F.filter(
        F.array(*[F.when(within(w, column), F.lit(w.name)) for w in calendar.named_windows(reader)]),
        lambda name: name.isNotNull(),
    )


def window_counts(df: DataFrame, calendar: Calendar) -> DataFrame:
    """Rows and late rate per window, from one scan."""
    return (
        df.select("is_late", F.explode(window_label(calendar, "counts")).alias("window"))
        .groupBy("window")
        .agg(F.count("*").alias("rows"), F.avg(F.col("is_late").cast("int")).alias("late_rate"))
    )


def ranked_in_time(df: DataFrame) -> tuple[DataFrame, int]:
    """Rows with their position in (purchase time, order id) order, and how many there are."""
    ranked = global_rank(df, TOTAL_ORDER)
    return ranked, ranked.count()


def fold_of(rank: Column, n: int, folds: int = CV_FOLDS) -> Column:
    """Validation fold of a position; the leading block validates nothing and gets 0.

    ``folds`` equal blocks are cut from the end. Fold f trains on every earlier position.
    """
    size = n // (folds + 1)
    if size == 0:
        raise ValueError(f"{n} rows cannot make {folds} folds")
    first = n - folds * size
    block = F.floor((rank - F.lit(first)) / F.lit(size)).cast("int") + 1
    return F.when(rank < first, F.lit(0)).otherwise(block)


def time_folds(df: DataFrame, folds: int = CV_FOLDS) -> DataFrame:
    """``df`` with ``rank`` and ``fold``."""
    ranked, n = ranked_in_time(df)
    return ranked.withColumn("fold", fold_of(F.col("rank"), n, folds))


def fold_sizes(folded: DataFrame) -> DataFrame:
    """Rows and positive rate of every validation fold, with the size of its training part."""
    per_fold = folded.groupBy("fold").agg(
        F.count("*").alias("validate_rows"),
        F.avg(F.col("is_late").cast("int")).alias("positive_rate"),
        F.min("rank").alias("train_rows"),
    )
    return per_fold.where(F.col("fold") > 0)


def halves(df: DataFrame, how: str = "interleaved") -> DataFrame:
    """``df`` with ``rank`` and ``first_half``: every other row in time order, or the earlier half."""
    if how == "interleaved":
        return global_rank(df, TOTAL_ORDER).withColumn("first_half", F.col("rank") % 2 == 0)
    if how == "temporal":
        ranked, n = ranked_in_time(df)
        return ranked.withColumn("first_half", F.col("rank") < F.lit(n // 2))
    raise ValueError(f"unknown split {how!r}; use 'interleaved' or 'temporal'")


def with_tail(df: DataFrame, share: float = EARLY_STOPPING_TAIL) -> DataFrame:
    """``df`` with ``rank`` and ``is_tail``, the last ``share`` of rows in time order."""
    ranked, n = ranked_in_time(df)
    cut = int(n * (1.0 - share))
    if not 1 <= cut < n:
        raise ValueError(f"a tail of {share} of {n} rows leaves nothing to train or stop on")
    return ranked.withColumn("is_tail", F.col("rank") >= F.lit(cut))


def out_of_order(df: DataFrame, rank: str = "rank", column: str = PURCHASED_AT) -> DataFrame:
    """How many rows are earlier than the row ranked just before them (ties are fine).

    Neighbours meet by joining on the position, so no window spans the table.
    """
    here = df.select(F.col(rank).alias("_at"), F.col(column).alias("_now"))
    before = df.select((F.col(rank) + 1).alias("_at"), F.col(column).alias("_then"))
    return here.join(before, "_at").agg(F.count_if(F.col("_now") < F.col("_then")).alias("violations"))


def check_calendar(calendar: Calendar) -> None:
    """Declared windows must be ordered, disjoint and consistent."""
    for version in calendar.versions:
        if version.calibrate.end >= calendar.evaluation.start or version.fit.end >= calendar.evaluation.start:
            raise ValueError(f"{version.version}: a window reaches the evaluation window")
        if version.aggregates_through != version.calibrate.end:
            raise ValueError(f"{version.version}: aggregates_through must equal the calibrate end")


def temporal_bounds(df: DataFrame, calendar: Calendar, version: str) -> DataFrame:
    """Observed window boundaries and whether they are in order, as one row.

    An empty window makes ``ordered`` false: a check over nothing must not pass.
    """
    windows = calendar.version(version)
    at = F.col(PURCHASED_AT)
    fit, calibrate = within(windows.fit), within(windows.calibrate)
    row = df.agg(
        F.count_if(fit).alias("fit_rows"),
        F.count_if(calibrate).alias("calibrate_rows"),
        F.max(F.when(fit, at)).alias("fit_max"),
        F.min(F.when(calibrate, at)).alias("calibrate_min"),
        F.max(F.when(calibrate, at)).alias("calibrate_max"),
    ).withColumn("evaluation_start", ntz(calendar.evaluation.start))
    ordered = (F.col("fit_max") < F.col("calibrate_min")) & (
        F.col("calibrate_max") < F.col("evaluation_start")
    )
    return row.withColumn("ordered", F.coalesce(ordered, F.lit(False)))


def require_temporal_order(df: DataFrame, calendar: Calendar, version: str) -> dict:
    check_calendar(calendar)
    row = temporal_bounds(df, calendar, version).first().asDict()
    if not row["fit_rows"] or not row["calibrate_rows"]:
        raise ValueError(f"{version}: a window holds no rows: {row}")
    if not row["ordered"]:
        raise ValueError(f"{version}: windows are out of order: {row}")
    return row


def evaluation_rows(df: DataFrame, calendar: Calendar, reader: str) -> DataFrame:
    """Rows of the evaluation window, for a reader it is open to."""
    return select_window(df, calendar.evaluation.opened_by(reader))
