"""The jobs: each reads published tables, does one step, and publishes its own.

``root`` is one folder on shared storage. Jobs only meet through what is published there, so
any of them can be run again after a failure.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import asof, contract, decision, explain, learning, metrics, profile, splits, versions
from tidemark.operators import folds as folds_of
from tidemark.operators.features import FEATURES, RAW_INPUTS
from tidemark.operators.geography import state_centroids, zip_centroids
from tidemark.operators.isotonic import fit_isotonic
from tidemark.operators.learning import SCORE, VALIDATION
from tidemark.operators.ledger import conservation, order_exits
from tidemark.operators.orders import orders_analytical
from tidemark.operators.population import order_funnel, order_outcomes
from tidemark.operators.preprocessing import HistoryPreprocessor, PreprocessingModel, contract_differences
from tidemark.operators.rollups import mean_review
from tidemark.operators.scoring import ScoringModel, route_records
from tidemark.session import configure, materialize
from tidemark.settings import (
    CV_FOLDS,
    FN_FP_COST_RATIO,
    GATE,
    MIN_BLEND_GAIN,
    PURCHASED_AT,
    SELECTION_BAND,
    STATE_REGIONS,
    Calendar,
)
from tidemark.sources.landing import land
from tidemark.sources.publish import append_rows, publish_all, read_published
from tidemark.sources.tables import RawTables

land_job = land

#: Files of the published orders are ordered by time, so their min/max statistics prune a window.
TIME_ORDER = (PURCHASED_AT, "order_id")


def orders_job(
    spark: SparkSession,
    raw: RawTables,
    calendar: Calendar,
    root: str,
    expected: contract.Contract | None = None,
) -> DataFrame:
    """Centroids, the analytical table, outcomes and the funnel; all or none become visible.

    Orders without items or payments cannot be described and are left out of the analytical
    table; outcomes are published for exactly the orders that were kept. Every raw order gets one
    exit reason, and nothing is published unless all counts follow from those. Returns the funnel.
    """
    configure(spark)
    window = calendar.analysis
    zips = materialize(zip_centroids(raw.geolocation))
    states = materialize(state_centroids(raw.geolocation))
    analytical = materialize(orders_analytical(raw, window, zips, states))
    outcomes = order_outcomes(raw.orders, window).join(analytical.select("order_id"), "order_id", "left_semi")
    funnel = order_funnel(raw.orders, window)
    exits = materialize(order_exits(raw, window, analytical))

    def check(written: Mapping[str, DataFrame]) -> None:
        contract.enforce(
            written["orders_analytical"], expected or contract.analytical_contract(), "orders_analytical"
        )
        contract.enforce(written["order_outcomes"], contract.outcome_contract(), "order_outcomes")
        tables = {name: written[name] for name in ("orders_analytical", "order_outcomes")}
        contract.require_conservation(conservation(written["order_exits"], written["funnel"], tables))

    written = publish_all(
        spark,
        root,
        {
            "zip_centroids": zips,
            "state_centroids": states,
            "orders_analytical": analytical.repartitionByRange(*TIME_ORDER),
            "order_outcomes": outcomes,
            "funnel": funnel.coalesce(1),
            "order_exits": exits,
        },
        check=check,
    )
    return written["funnel"]


def snapshots_job(spark: SparkSession, calendar: Calendar, root: str) -> DataFrame:
    """All snapshot levels, one partition per level. Returns rows per level."""
    configure(spark)
    resolved = asof.resolved_history(
        read_published(spark, root, "orders_analytical"), read_published(spark, root, "order_outcomes")
    )
    ledger = asof.snapshot_ledger(resolved, calendar.analysis)

    def check(written: Mapping[str, DataFrame]) -> None:
        repeats = contract.repeated_keys(written["snapshots"], ["level", "key", "snapshot_month"])
        if not repeats.isEmpty():
            raise contract.ContractViolation("a snapshot key occurs twice; joins to it would fan out")

    written = publish_all(
        spark, root, {"snapshots": ledger}, partition_by={"snapshots": ["level"]}, check=check
    )
    return asof.snapshot_sizes(written["snapshots"])


@dataclass(frozen=True)
class Matrix:
    """Features, label and purchase time of every order, with the model that made them."""

    rows: DataFrame
    preprocessing: PreprocessingModel
    calendar: Calendar
    version: str

    def fit_rows(self) -> DataFrame:
        return splits.select_window(self.rows, self.calendar.version(self.version).fit)

    def calibrate_rows(self) -> DataFrame:
        return splits.select_window(self.rows, self.calendar.version(self.version).calibrate)


def build_matrix(
    spark: SparkSession,
    calendar: Calendar,
    version: str,
    root: str,
    regions: Mapping[str, str] = STATE_REGIONS,
) -> Matrix:
    """Fit preprocessing on the version's fit window and build the matrix of all orders."""
    configure(spark)
    windows = calendar.version(version)
    orders = read_published(spark, root, "orders_analytical")
    ledger = read_published(spark, root, "snapshots")
    splits.require_temporal_order(orders, calendar, version)
    snapshots = asof.stored_levels(ledger)
    estimator = HistoryPreprocessor(ledger, windows.aggregates_through, windows.fit.end, regions)
    model = estimator.fit(asof.attach_history(splits.select_window(orders, windows.fit), snapshots))
    labels = read_published(spark, root, "order_outcomes").select(
        "order_id", F.col("is_late").cast("int").alias(metrics.LABEL)
    )
    matrix = model.transform_with_snapshots(orders, snapshots, ["order_id", PURCHASED_AT])
    return Matrix(matrix.join(labels, "order_id"), model, calendar, version)


def feature_report(matrix: Matrix) -> DataFrame:
    """Nulls per feature over the matrix before imputation are gone; this is the check."""
    return profile.null_report(matrix.rows, FEATURES)


@dataclass(frozen=True)
class Tuned:
    params: dict[str, dict]
    report: DataFrame
    trials: DataFrame
    weighting: DataFrame


def tune_job(
    matrix: Matrix,
    families: tuple[str, ...] = ("gbt", "forest"),
    trials: int = 40,
    timeout_seconds: float | None = None,
    folds: int = CV_FOLDS,
) -> Tuned:
    """Baselines and searched families on the same folds of the fit window. A time cap makes the
    parameters depend on the machine; when it strikes, that is logged."""
    ranked, n = splits.ranked_in_time(matrix.fit_rows())
    levels = matrix.preprocessing.levels
    # Coded once: every trial fits every fold anew.
    coded = [learning.family_fitter(f, levels) for f in ("logistic", *families)]
    folded = learning.coded(coded, ranked.withColumn("fold", splits.fold_of(F.col("rank"), n, folds)))
    rates = folds_of.usable_rates(folded, folds)
    scores = {
        "majority": learning.cross_validate(folded, learning.majority_fitter(), folds),
        "logistic": learning.cross_validate(folded, learning.family_fitter("logistic", levels), folds),
    }
    params: dict[str, dict] = {}
    log = None
    for family in families:
        result, trial_log = learning.search(family, folded, levels, folds, trials, timeout_seconds)
        params[family] = result.best_params
        scores[family] = result.fold_scores
        log = trial_log if log is None else log.unionByName(trial_log)
    weighting = learning.weighted_experiment(folded, families[0], levels, params[families[0]], folds)
    report = learning.comparison_report(scores, rates, matrix.rows)
    return Tuned(params, report, log, weighting)


@dataclass(frozen=True)
class Decision:
    model: ScoringModel
    chosen: str
    blend: decision.BlendVerdict
    threshold: DataFrame
    calibration: DataFrame


def fit_final(matrix: Matrix, family: str, params: Mapping) -> PipelineModel:
    """Fit on the whole fit window; its chronological tail stops boosting early."""
    rows = materialize(splits.with_tail(matrix.fit_rows()).withColumnRenamed("is_tail", VALIDATION))
    return learning.fit_model(family, rows, matrix.preprocessing.levels, params)


def decide_job(
    matrix: Matrix,
    params: Mapping[str, Mapping],
    costs: Mapping[str, float] = learning.SERVING_COST,
    ratio: float = FN_FP_COST_RATIO,
    how: str = "interleaved",
) -> Decision:
    """Refit, then blend and choose on one half of the calibration window, calibrate and cut on
    the other. The first half also shows what calibration is worth on rows it did not see."""
    models = {family: fit_final(matrix, family, p) for family, p in params.items()}
    names = sorted(models)
    scored = splits.halves(matrix.calibrate_rows(), how)
    for name in names:
        kept = [c for c in scored.columns if c not in (SCORE, "features", "rawPrediction", "probability", "prediction")]
        scored = learning.positive_score(models[name], scored, name, keep=kept)
    scored = materialize(scored.select("order_id", PURCHASED_AT, "first_half", metrics.LABEL, *names))
    first, second = scored.where("first_half"), scored.where("not first_half")

    weights = decision.fit_blend_weights(first, names)
    verdict = decision.evaluate_blend(first, weights, MIN_BLEND_GAIN)
    single = decision.choose_model(scored.sparkSession, verdict.single_pr_auc, costs, SELECTION_BAND)
    chosen = "blend" if verdict.ship_blend else single
    used = weights if verdict.ship_blend else {single: 1.0}

    shipped = decision.blend(sorted(used), [used[n] for n in sorted(used)]).alias(SCORE)
    held_out = materialize(first.select(metrics.LABEL, shipped))
    fit_on = materialize(second.select(metrics.LABEL, shipped))
    calibrator = fit_isotonic(fit_on)
    calibrated = materialize(learning.calibrate(calibrator, fit_on))
    best = metrics.best_threshold(metrics.cost_curve(calibrated, ratio))
    # A threshold of exactly 0 or 1 flags everything or nothing; keep it strictly inside.
    threshold = min(max(best.first()["threshold"], 1e-9), 1 - 1e-9)
    scoring = ScoringModel(
        matrix.preprocessing.with_threshold(threshold), {n: models[n] for n in used}, used, calibrator
    )
    report = learning.calibration_report(calibrator, {"fitted": fit_on, "held_out": held_out})
    return Decision(scoring, chosen, verdict, best, report)


DECISIONS = "promotion_log"
SUMMARIES = "model_summaries"
SCHEMA_GAPS = "schema_differences"
VERSION_TAGS = (
    "shipped_model",
    "threshold",
    "training_window",
    "calibration_window",
    "evaluation_pr_auc",
    "status",
    "withdrawn_reason",
    "path",
)


def describe_versions(spark: SparkSession, root: str) -> DataFrame:
    """Tags, status, reason of withdrawal and aliases of every version."""
    return versions.described(versions.events(spark, root), VERSION_TAGS)


def train_job(matrix: Matrix, decided: Decision, root: str) -> tuple[str, str]:
    """Save a decided model as the next version. The first is champion, later ones challenge.

    Of two jobs that saw the same versions the second is refused when it records its own.
    """
    spark = matrix.rows.sparkSession
    seen = versions.head(spark, root)
    known = materialize(versions.events(spark, root))
    version = str(known.agg(F.coalesce(F.max(F.col("version").cast("int")), F.lit(0))).first()[0] + 1)
    path = f"{root}/models/{version}-{uuid.uuid4().hex}"
    decided.model.save_to(path)
    windows = matrix.calendar.version(matrix.version)
    uncontested = versions.holders(known).where(F.col("alias") == "champion").isEmpty()
    alias = "champion" if uncontested else "challenger"
    tags = {
        "path": path,
        "shipped_model": decided.chosen,
        "threshold": f"{decided.model.preprocessing.threshold:.5f}",
        "training_window": f"{windows.fit.start}..{windows.fit.end}",
        "calibration_window": f"{windows.calibrate.start}..{windows.calibrate.end}",
        "blend_delta_pr_auc": f"{decided.blend.delta:.5f}",
        "evaluation_pr_auc": "pending",
    }
    changes = [(version, field, value) for field, value in tags.items()]
    versions.record(spark, root, [*changes, *versions.moves(known, version, alias)], seen)
    summary = decided.model.preprocessing.summary().select(F.lit(version).alias("version"), "*")
    append_rows(summary.coalesce(1), root, SUMMARIES)
    return version, alias


def rollback_job(spark: SparkSession, root: str, version: str, reason: str) -> None:
    """Make an archived version champion again; the present champion is archived with the reason."""
    seen = versions.head(spark, root)
    known = materialize(versions.events(spark, root))
    present = versions.resolve(known, "@champion")
    changes = versions.moves(known, present, "archived", f"archived: {reason}")
    versions.record(spark, root, [*changes, *versions.moves(known, version, "champion")], seen)


def version_path(log: DataFrame, version: str) -> str:
    row = versions.state(log).where((F.col("version") == version) & (F.col("field") == "path")).first()
    return row["value"] if row else version


def load_version(spark: SparkSession, root: str, reference: str) -> tuple[str, ScoringModel]:
    """Load by ``@alias``, pinned version or path."""
    log = versions.events(spark, root)
    version = versions.resolve(log, reference)
    return version, ScoringModel.load_from(spark, version_path(log, version))


def holdout_frame(spark: SparkSession, calendar: Calendar, root: str, reader: str) -> DataFrame:
    """Raw records and labels of the evaluation window."""
    orders = read_published(spark, root, "orders_analytical")
    rows = splits.evaluation_rows(orders, calendar, reader)
    if rows.isEmpty():
        raise ValueError("the evaluation window holds no orders")
    labels = read_published(spark, root, "order_outcomes").select(
        "order_id", F.col("is_late").cast("int").alias(metrics.LABEL)
    )
    return rows.select("order_id", *RAW_INPUTS).join(labels, "order_id")


def score_holdout(model: ScoringModel, version: str, rows: DataFrame, p95_latency_ms: float) -> DataFrame:
    """One row of evaluation metrics of one version."""
    scored = materialize(
        model.predict(rows, ["order_id", PURCHASED_AT, metrics.LABEL]).withColumnRenamed("probability", SCORE)
    )
    n, _ = metrics.require_scores(scored, both_classes=True, probabilities=True)
    if n != rows.count():
        raise ValueError(f"version {version} scored {n} rows of {rows.count()}")
    threshold = model.preprocessing.threshold
    cut = metrics.confusion(scored, threshold).first()
    base = F.col("positives") / F.col("rows")
    return metrics.areas(metrics.ranking_curve(scored)).select(
        F.lit(version).alias("model_version"),
        F.col("rows").alias("n_rows"),
        base.alias("base_rate"),
        "pr_auc",
        (F.col("pr_auc") / base).alias("lift"),
        "roc_auc",
        metrics.brier(scored).scalar().alias("brier"),
        F.lit(float(threshold)).alias("threshold"),
        *[F.lit(float(cut[c])).alias(c) for c in ("recall", "precision", "flag_rate")],
        F.lit(float(p95_latency_ms)).alias("p95_latency_ms"),
    )


def batch_p95(model: ScoringModel, rows: DataFrame, samples: int = 60, size: int = 100, warm_up: int = 5) -> float:
    """Nearest-rank p95 of the time to score one small batch of records, after a warm-up."""
    import time

    sample = materialize(profile.seeded_sample(rows, "order_id", size))
    for _ in range(warm_up):
        model.predict(sample, ["order_id"]).write.format("noop").mode("overwrite").save()
    timings = []
    for _ in range(samples):
        started = time.perf_counter()
        model.predict(sample, ["order_id"]).write.format("noop").mode("overwrite").save()
        timings.append(((time.perf_counter() - started) * 1000.0,))
    durations = rows.sparkSession.createDataFrame(timings, "duration_ms double")
    return metrics.nearest_rank(durations, "duration_ms")


DECISION_SCHEMA = (
    "decided_at timestamp_ntz, challenger string, champion string, position int, check string, "
    "passed boolean, value double, bar double, promoted boolean"
)


def promote_job(
    spark: SparkSession, calendar: Calendar, root: str, gate: Mapping[str, float] = GATE
) -> DataFrame:
    """Compare challenger and champion on the locked window; move the alias if every check passes.

    The decision is logged whether or not it passes. Returns the checks.
    """
    configure(spark)
    decision.check_gate(gate)
    seen = versions.head(spark, root)
    known = materialize(versions.events(spark, root))
    holders = {r["alias"]: r["version"] for r in versions.holders(known).collect()}
    if "challenger" not in holders:
        raise LookupError("no version is waiting as challenger")
    scores = {}
    gaps = materialize(contract_differences(spark, f"{version_path(known, holders['challenger'])}/preprocessing"))
    many = gaps.count()
    if many:
        # A model of another contract cannot score this code's rows; the refusal is logged like any other.
        append_rows(gaps.select(F.lit(holders["challenger"]).alias("version"), "*").coalesce(1), root, SCHEMA_GAPS)
        checks = decision.schema_refusal(spark, many)
    else:
        rows = materialize(holdout_frame(spark, calendar, root, "promote"))
        for alias in ("challenger", "champion"):
            if alias in holders and (alias == "challenger" or holders[alias] != holders["challenger"]):
                version, model = load_version(spark, root, f"@{alias}")
                scores[alias] = materialize(score_holdout(model, version, rows, batch_p95(model, rows)))
        checks = materialize(decision.gate_checks(scores["challenger"], scores.get("champion"), schema_gaps=0, gate=gate))
    promoted = decision.gate_verdict(checks).first()["promoted"]
    challenger, champion = holders["challenger"], holders.get("champion")
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    log = checks.select(
        F.lit(now).cast("timestamp_ntz").alias("decided_at"),
        F.lit(challenger).alias("challenger"),
        F.lit(champion).cast("string").alias("champion"),
        *checks.columns,
        F.lit(promoted).alias("promoted"),
    )
    append_rows(log.coalesce(1), root, DECISIONS)
    changes: list[versions.Change] = []
    if scores:
        changes.append((challenger, "evaluation_pr_auc", f"{scores['challenger'].first()['pr_auc']:.5f}"))
    if promoted:
        if champion and champion != challenger:
            changes += versions.moves(known, champion, "archived", f"archived: superseded by version {challenger} through the promotion gate")
        changes += versions.moves(known, challenger, "champion")
    if changes:
        versions.record(spark, root, changes, seen)
    return checks


def holdout_reference(
    matrix: Matrix, model: ScoringModel, root: str
) -> DataFrame:
    """Majority, logistic baseline and the given model on identical evaluation rows."""
    spark = matrix.rows.sparkSession
    held_out = materialize(splits.evaluation_rows(matrix.rows, matrix.calendar, "holdout"))
    fit_rows = materialize(matrix.fit_rows())
    majority = learning.MajorityBaseline.fit(fit_rows).score(held_out).select(metrics.LABEL, SCORE)
    linear = learning.fit_model("logistic", fit_rows, matrix.preprocessing.levels)
    records = holdout_frame(spark, matrix.calendar, root, "holdout")
    frames = {
        "majority": majority,
        "logistic": learning.positive_score(linear, held_out, keep=[metrics.LABEL]),
        "model": model.predict(records, [metrics.LABEL]).select(metrics.LABEL, F.col("probability").alias(SCORE)),
    }
    out = None
    for name, frame in frames.items():
        kept = materialize(frame)
        row = metrics.areas(metrics.ranking_curve(kept)).select(
            F.lit(name).alias("model"), "pr_auc", "roc_auc", metrics.brier(kept).scalar().alias("brier"), "rows"
        )
        out = row if out is None else out.unionByName(row)
    return out


def explain_job(matrix: Matrix, sample: int | None = None) -> dict[str, DataFrame]:
    """Attributions of all fit rows under the linear model: ranking, additivity and alarms.
    ``sample`` asks for a seeded sample of so many rows instead.

    Attributions of a row plus the base add up to the model's own margin; the gap says by how
    much they fail to.
    """
    fit_rows = materialize(matrix.fit_rows())
    model = learning.fit_model("logistic", fit_rows, matrix.preprocessing.levels)
    parts, intercept = learning.linear_contributions(model, matrix.preprocessing.levels)
    rows = fit_rows if sample is None else materialize(profile.seeded_sample(fit_rows, "order_id", sample))
    contributions = materialize(rows.select("order_id", *[c.alias(f) for f, c in parts.items()]))
    names = list(parts)
    attributions, shift = explain.centred(contributions, names, ["order_id"])
    checked = attributions.join(learning.margin(model, rows, ["order_id"]), "order_id")
    ranking = explain.mean_abs_attribution(attributions, names)
    return {
        "attributions": attributions,
        "ranking": ranking,
        "additivity": explain.additivity_gap(checked, names, intercept + shift, "margin"),
        "alarms": explain.leakage_alarms(ranking),
    }


def score_job(
    spark: SparkSession, root: str, records: DataFrame, output: str, reference: str = "@champion", key: str = "order_id"
) -> dict[str, DataFrame]:
    """Batch scoring: route, score, and publish scored, rejected and unseen tables together."""
    configure(spark)
    _, model = load_version(spark, root, reference)
    accepted, rejected = route_records(records)
    predictions, unseen = model.predict_with_report(materialize(accepted), [key])
    return publish_all(spark, output, {"scored": predictions, "rejected": rejected, "unseen": unseen})


def review_job(spark: SparkSession, raw: RawTables, root: str) -> DataFrame:
    """Review impact; refuses to run if a review column ever became a feature."""
    leaked = [f for f in FEATURES if f.startswith("review")]
    if leaked:
        raise RuntimeError(f"review columns reached the features: {leaked}")
    outcomes = read_published(spark, root, "order_outcomes")
    return profile.review_impact(outcomes, mean_review(raw.reviews))
