"""The whole chain on the small star tables: publish, fit, decide, save, promote, score, stream."""

import inspect
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators import asof, contract, decision, learning, versions
from tidemark.operators.features import FEATURES, RAW_INPUTS, construct_features
from tidemark.operators.preprocessing import PreprocessingModel
from tidemark.operators.scoring import ScoringModel, require_batch_size, route_records
from tidemark.plans import jobs
from tidemark.settings import GATE, STAR
from tidemark.sources.publish import read_published
from tidemark.sources.reports import markdown
from tidemark.sources.star import STAR_REGIONS, StarTables
from tidemark.streaming.scoring import conform, read_records, score_stream


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("jobs"))
    report = jobs.orders_job(spark, StarTables(spark, SF_SMALL), STAR, folder, contract.star_contract())
    assert "delivery date not null" in markdown(report, "Funnel")
    assert jobs.snapshots_job(spark, STAR, folder).count() == len(asof.LEVELS)
    return folder


@pytest.fixture(scope="module")
def matrix(spark, root):
    return jobs.build_matrix(spark, STAR, "v1", root, STAR_REGIONS)


@pytest.fixture(scope="module")
def decided(matrix):
    return jobs.decide_job(matrix, {"logistic": {}, "forest": {"numTrees": 5, "maxDepth": 3}})


def test_contract_refuses_star_data_under_the_other_countrys_rules(spark, tmp_path):
    with pytest.raises(contract.ContractViolation, match="length_2"):
        jobs.orders_job(spark, StarTables(spark, SF_SMALL), STAR, str(tmp_path))


def test_matrix_is_complete_and_ordered(matrix):
    assert [c for c in matrix.rows.columns if c in FEATURES] == list(FEATURES)
    assert all(r["nulls"] == 0 for r in jobs.feature_report(matrix).collect())
    assert matrix.fit_rows().count() == matrix.preprocessing.train_rows


def test_preprocessing_survives_saving(spark, matrix, root, tmp_path):
    path = str(tmp_path / "p")
    matrix.preprocessing.save_to(path)
    loaded = PreprocessingModel.load_from(spark, path)
    orders = read_published(spark, root, "orders_analytical")
    a = matrix.preprocessing.transform(orders).orderBy("order_id").collect()
    assert a == loaded.transform(orders).orderBy("order_id").collect()
    assert loaded.manifest() == matrix.preprocessing.manifest()
    with pytest.raises(ValueError):
        loaded.with_threshold(1.0)
    saved = spark.read.text(f"{path}/manifest").first()["value"]
    other = saved.replace(loaded.schema_hash, "0" * 16)
    spark.createDataFrame([(other,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    with pytest.raises(ValueError, match="contract changed"):
        PreprocessingModel.load_from(spark, path)


def test_construction_guards(spark, matrix, root):
    orders = read_published(spark, root, "orders_analytical")
    model = matrix.preprocessing
    with pytest.raises(ValueError, match="missing"):
        construct_features(orders, model.levels, model.winsor)
    attached = asof.attach_history(orders, asof.levels_of(read_published(spark, root, "snapshots")))
    with pytest.raises(ValueError, match="after purchase"):
        construct_features(attached.withColumn("review_score", F.lit(1)), model.levels, model.winsor)


def test_unknown_and_missing_levels_stay_apart(spark, matrix, root):
    row = read_published(spark, root, "orders_analytical").limit(1)
    odd = row.withColumns({"dominant_category": F.lit(None).cast("string"), "seller_state": F.lit("nowhere")})
    got = matrix.preprocessing.transform(odd).first()
    assert got["product_category"] == "__missing__" and got["seller_state"] == "__unknown__"


def test_serving_matches_training_when_the_month_matches(spark, matrix, root):
    """Orders bought in the bundled month read the same snapshot on both paths."""
    model = matrix.preprocessing
    orders = read_published(spark, root, "orders_analytical")
    same = orders.where(F.col("purchase_month") == F.lit(str(model.month)).cast("timestamp_ntz"))
    assert same.count() > 0
    snapshots = asof.levels_of(read_published(spark, root, "snapshots"))
    a = model.transform_with_snapshots(same, snapshots, ["order_id"]).orderBy("order_id").collect()
    assert a == model.transform(same).orderBy("order_id").collect()


def test_saved_scorer_scores_the_same(spark, decided, root, tmp_path):
    records = conform(read_published(spark, root, "orders_analytical"))
    path = str(tmp_path / "m")
    decided.model.save_to(path)
    first = decided.model.predict(records, ["order_id"]).orderBy("order_id").collect()
    second = ScoringModel.load_from(spark, path).predict(records, ["order_id"]).orderBy("order_id").collect()
    assert len(first) == records.count()
    for x, y in zip(first, second, strict=True):
        assert x["probability"] == pytest.approx(y["probability"], abs=1e-9)
        assert 0.0 <= x["probability"] <= 1.0 and x["is_late_predicted"] == (x["probability"] >= x["threshold"])


def test_scoring_guards(spark, decided, root):
    orders = read_published(spark, root, "orders_analytical")
    with pytest.raises(ValueError, match="computed here"):
        decided.model.predict(orders)
    with pytest.raises(ValueError, match="missing"):
        decided.model.predict(conform(orders).drop(RAW_INPUTS[0]))
    with pytest.raises(ValueError):
        require_batch_size(orders, 10)
    accepted, rejected = route_records(conform(orders).withColumn("n_items", F.lit(0)))
    assert accepted.count() == 0 and rejected.first()["reasons"] == ["n_items:at_least_1"]


def test_versions_promotion_and_rollback(spark, matrix, decided, root):
    assert jobs.train_job(matrix, decided, root) == ("1", "champion")
    assert jobs.train_job(matrix, decided, root) == ("2", "challenger")
    checks = {r["check"]: r["passed"] for r in jobs.promote_job(spark, STAR, root).collect()}
    assert checks["pr_auc"] is False and checks["brier"] and checks["feature_schema"]
    assert versions.resolve(versions.events(spark, root), "@champion") == "1"
    assert jobs.load_version(spark, root, "2")[0] == "2"
    # A weaker bar lets the same model through once.
    relaxed = {**GATE, "min_delta_pr_auc": -1.0, "max_p95_latency_ms": 1e9}
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(decision, "check_gate", lambda *_: None)
        assert all(r["passed"] for r in jobs.promote_job(spark, STAR, root, relaxed).collect())
    rows = {r["version"]: r for r in jobs.describe_versions(spark, root).collect()}
    assert rows["2"]["aliases"] == "champion" and rows["2"]["status"] == "champion"
    assert rows["1"]["aliases"] == "" and rows["1"]["status"] == "archived" and "version 2" in rows["1"]["withdrawn_reason"]
    assert rows["2"]["evaluation_pr_auc"] != "pending"
    with pytest.raises(LookupError, match="challenger"):
        jobs.promote_job(spark, STAR, root)
    assert spark.read.parquet(f"{root}/{jobs.DECISIONS}").count() == 4 + 4
    assert spark.read.parquet(f"{root}/{jobs.SUMMARIES}").count() == 2

    jobs.rollback_job(spark, root, "1", "wrong on holidays")
    rows = {r["version"]: r for r in jobs.describe_versions(spark, root).collect()}
    assert rows["1"]["aliases"] == "champion" and rows["1"]["withdrawn_reason"] is None
    assert rows["2"]["status"] == "archived" and "holidays" in rows["2"]["withdrawn_reason"]

    # A challenger of another contract is refused with a record, not with an exception.
    assert jobs.train_job(matrix, decided, root) == ("3", "challenger")
    path = f"{jobs.version_path(versions.events(spark, root), '3')}/preprocessing/manifest"
    saved = json.loads(spark.read.text(path).first()["value"])
    saved["schema_hash"] = "0" * 64
    saved["contract"] = [f if f[2] != FEATURES[0] or f[0] != "feature" else [f[0], f[1], "older_name", f[3]] for f in saved["contract"]]
    spark.createDataFrame([(json.dumps(saved),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    refused = {r["check"]: (r["passed"], r["value"]) for r in jobs.promote_job(spark, STAR, root).collect()}
    assert refused["feature_schema"] == (False, 3.0)
    gaps = {r["name"]: (r["saved"] is None, r["current"] is None) for r in spark.read.parquet(f"{root}/{jobs.SCHEMA_GAPS}").collect()}
    assert gaps == {"hash": (False, False), "older_name": (False, True), FEATURES[0]: (True, False)}
    assert spark.read.parquet(f"{root}/{jobs.DECISIONS}").where("challenger = '3' AND NOT promoted").count() == 4
    assert versions.resolve(versions.events(spark, root), "@champion") == "1"


def test_preprocessing_summary(matrix):
    row = matrix.preprocessing.summary().first()
    assert row["train_rows"] == matrix.preprocessing.train_rows and row["features"] == len(FEATURES)
    assert row["levels"].keys() == matrix.preprocessing.levels.keys() and row["bundled_rows"] == matrix.preprocessing.bundled.count()


def test_batch_and_stream_give_the_same_decisions(spark, decided, root, tmp_path):
    records = conform(read_published(spark, root, "orders_analytical")).limit(60)
    bad = records.limit(1).withColumns({"order_id": F.lit("bad"), "n_items": F.lit(0)})
    records.unionByName(bad).repartition(3).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        score_stream(read_records(spark, str(tmp_path / "in"), files_per_batch=1), decided.model, out).awaitTermination()
    scored = spark.read.parquet(f"{out}/scored")
    rejected = spark.read.parquet(f"{out}/rejected")
    assert scored.count() == 60 and [r["order_id"] for r in rejected.collect()] == ["bad"]
    batch = {r["order_id"]: r["probability"] for r in decided.model.predict(records, ["order_id"]).collect()}
    assert {r["order_id"]: r["probability"] for r in scored.collect()} == pytest.approx(batch)
    assert spark.read.parquet(f"{out}/durations").count() >= 3


def test_review_impact(spark, root):
    rows = jobs.review_job(spark, StarTables(spark, SF_SMALL), root).collect()
    assert {r["is_late"] for r in rows} == {True, False} and all(r["with_review"] < r["orders"] for r in rows)


def test_attributions_cover_all_fit_rows(matrix):
    out = jobs.explain_job(matrix)
    assert out["attributions"].count() == matrix.fit_rows().count()


def test_search_has_no_time_cap_unless_asked(matrix, monkeypatch, caplog):
    from itertools import count

    assert inspect.signature(jobs.tune_job).parameters["timeout_seconds"].default is None
    clock = count(0, 10_000)
    monkeypatch.setattr(learning.time, "monotonic", lambda: next(clock))
    monkeypatch.setattr(learning, "cross_validate", lambda *_: [0.5])
    args = ("gbt", matrix.rows, matrix.preprocessing.levels, 2, 3)
    assert not learning.search(*args)[0].timed_out and not caplog.records
    assert learning.search(*args, 900.0)[0].trials_completed == 1 and "time cap" in caplog.text


def test_tuning_codes_its_rows_once(matrix, monkeypatch):
    made, plain = [], learning.coded
    monkeypatch.setattr(learning, "coded", lambda *args: made.append(plain(*args)) or made[-1])
    monkeypatch.setitem(learning.FIXED, "forest", {"numTrees": 3, "seed": learning.SEED})
    tuned = jobs.tune_job(matrix, ("forest",), 2, folds=2)
    assert len(made) == 1 and "class_weight" not in made[0].columns
    assert {(r["model"], r["fold"]) for r in tuned.report.collect()} == {(m, f) for m in ("majority", "logistic", "forest") for f in (1, 2)}
    assert tuned.trials.count() == 2 and tuned.weighting.count() == 2


def test_linear_attributions_add_up_to_the_margin(matrix):
    out = jobs.explain_job(matrix, 50)
    assert out["attributions"].count() == 50
    assert out["additivity"].first()[0] < 1e-9
    assert "promised_days" in [r["feature"] for r in out["ranking"].collect()]
