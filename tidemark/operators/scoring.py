"""From raw order records to calibrated decisions."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.contract import Rule, at_least, failing_rows, not_null
from tidemark.operators.decision import blend
from tidemark.operators.features import CATEGORICAL_SOURCES, COMPUTED_COLUMNS, RAW_INPUTS
from tidemark.operators.learning import calibrate
from tidemark.operators.metrics import SCORE
from tidemark.operators.preprocessing import PreprocessingModel
from tidemark.operators.profile import unseen_categories
from tidemark.session import materialize

# Columns of a prediction.
OUTPUT_COLUMNS = ("probability", "is_late_predicted", "threshold")

#: Raw inputs that may be null.
OPTIONAL_INPUTS = frozenset(
    {
        "customer_seller_distance_km",
        "dominant_payment_type",
        "total_weight_g",
        "max_item_weight_g",
        "total_volume_cm3",
        "max_item_volume_cm3",
        "dominant_category",
    }
)


def _text_length(column: str, low: int, high: int) -> Rule:
    return Rule(f"length_{low}_{high}", column, F.length(column).between(low, high))


def record_rules() -> list[Rule]:
    """Value rules of a scoring record. Zero instalments are allowed, as the table allows them."""
    rules = [not_null(c) for c in RAW_INPUTS if c not in OPTIONAL_INPUTS]
    rules += [at_least(c, 0) for c in (
        "promised_days",
        "customer_seller_distance_km",
        "total_price",
        "total_freight",
        "total_payment_value",
        "max_installments",
        "total_weight_g",
        "max_item_weight_g",
        "total_volume_cm3",
        "max_item_volume_cm3",
    )]
    rules += [at_least(c, 1) for c in (
        "n_seller_states",
        "n_items",
        "n_distinct_products",
        "n_distinct_sellers",
        "n_payment_methods",
    )]
    return rules


def code_length_rules() -> list[Rule]:
    """Text lengths, where states are codes."""
    return [
        _text_length("customer_state", 1, 8),
        _text_length("seller_state", 1, 8),
        _text_length("customer_zip_code_prefix", 1, 16),
    ]


def route_records(records: DataFrame, rules: Sequence[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted records, and rejected ones with the reasons why."""
    judged = failing_rows(records, record_rules() if rules is None else rules)
    accepted = judged.where(F.size("reasons") == 0).drop("reasons")
    return accepted, judged.where(F.size("reasons") > 0)


def require_raw_inputs(records: DataFrame) -> None:
    absent = [c for c in RAW_INPUTS if c not in records.columns]
    if absent:
        raise ValueError(f"scoring inputs are missing: {absent}")
    computed = sorted(COMPUTED_COLUMNS.intersection(records.columns))
    if computed:
        raise ValueError(f"these are computed here and may not be supplied: {computed}")


def require_batch_size(records: DataFrame, cap: int) -> None:
    """Refuse an oversized request; reads no more than one row past the cap."""
    if records.limit(cap + 1).count() > cap:
        raise ValueError(f"a request may hold at most {cap} records")


def raw_sources(records: DataFrame) -> DataFrame:
    """Keep the raw value of every categorical source beside the features built from it."""
    return records.withColumns({f"raw_{c}": F.col(c) for c in sorted(set(CATEGORICAL_SOURCES.values()))})


RAW_SOURCE_COLUMNS = tuple(f"raw_{c}" for c in sorted(set(CATEGORICAL_SOURCES.values())))


@dataclass(frozen=True)
class ScoringModel:
    """Everything a decision needs: preprocessing, models with weights, calibration, threshold."""

    preprocessing: PreprocessingModel
    models: Mapping[str, PipelineModel]
    weights: Mapping[str, float]
    calibrator: IsotonicRegressionModel | None

    def __post_init__(self) -> None:
        if self.preprocessing.threshold is None:
            raise ValueError("a scoring model needs a threshold")
        if set(self.models) != set(self.weights):
            raise KeyError(f"models {sorted(self.models)} do not match weights {sorted(self.weights)}")

    def _matrix(self, records: DataFrame, keep: Sequence[str]) -> DataFrame:
        return self.preprocessing.transform_latest(raw_sources(records), [*keep, *RAW_SOURCE_COLUMNS])

    def _decide(self, matrix: DataFrame, keep: Sequence[str]) -> DataFrame:
        scored, names = matrix, sorted(self.models)
        for name in names:
            spare = [c for c in matrix.columns] + [f"p_{n}" for n in names if f"p_{n}" in scored.columns]
            scored = self.models[name].transform(scored).select(
                *spare, vector_to_array("probability")[1].alias(f"p_{name}")
            )
        blended = blend([f"p_{n}" for n in names], [self.weights[n] for n in names])
        scored = scored.withColumn(SCORE, blended)
        if self.calibrator is not None:
            scored = calibrate(self.calibrator, scored)
        threshold = F.lit(float(self.preprocessing.threshold))
        return scored.select(
            *keep,
            F.col(SCORE).alias("probability"),
            (F.col(SCORE) >= threshold).alias("is_late_predicted"),
            threshold.alias("threshold"),
        )

    def predict(self, records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Guarded scoring of raw records."""
        require_raw_inputs(records)
        return self._decide(self._matrix(records, keep), keep)

    def predict_with_report(self, records: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
        """Predictions and the unseen-category table, both from one transform."""
        require_raw_inputs(records)
        matrix = materialize(self._matrix(records, keep))
        return self._decide(matrix, keep), unseen_categories(matrix)

    def describe(self) -> dict:
        return {
            **self.preprocessing.manifest(),
            "models": {n: float(self.weights[n]) for n in sorted(self.models)},
            "has_calibrator": self.calibrator is not None,
        }

    def save_to(self, path: str) -> None:
        self.preprocessing.save_to(f"{path}/preprocessing")
        for name, model in self.models.items():
            model.write().overwrite().save(f"{path}/models/{name}")
        if self.calibrator is not None:
            self.calibrator.write().overwrite().save(f"{path}/calibrator")
        line = json.dumps({"weights": dict(self.weights), "calibrated": self.calibrator is not None})
        spark = self.preprocessing.bundled.sparkSession
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/weights")

    @staticmethod
    def load_from(spark: SparkSession, path: str) -> ScoringModel:
        saved = json.loads(spark.read.text(f"{path}/weights").first()["value"])
        return ScoringModel(
            PreprocessingModel.load_from(spark, f"{path}/preprocessing"),
            {name: PipelineModel.load(f"{path}/models/{name}") for name in saved["weights"]},
            saved["weights"],
            IsotonicRegressionModel.load(f"{path}/calibrator") if saved["calibrated"] else None,
        )
