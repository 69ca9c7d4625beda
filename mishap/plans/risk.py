"""Risk classes: label, split, train, predict and evaluate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.functions.labels import risk_class
from mishap.operators.forest import (
    FeatureSet,
    ForestParams,
    RiskModel,
    feature_importance,
    fit_forest,
    predict,
)
from mishap.operators.hygiene import quoted
from mishap.operators.joins import pin
from mishap.operators.metrics import balanced_accuracy, classification_report, confusion_matrix
from mishap.operators.sampling import stratified_split


@dataclass(frozen=True)
class RiskRun:
    model: RiskModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame
    importance: DataFrame


def with_risk(df: DataFrame, severity: str = S.SEVERITY) -> DataFrame:
    """Add the risk class; a severity outside 1 to 4 has none."""
    return df.withColumn(S.RISK, risk_class(F.col(quoted(severity))))


def train_risk(
    df: DataFrame,
    row_id: str = S.INCIDENT_ID,
    features: FeatureSet = FeatureSet(),
    params: ForestParams = ForestParams(),
    test_fraction: float = 0.2,
) -> RiskRun:
    """Split the labelled rows by class, train on the one part and predict the other.

    The input is read several times, so it should be a written table. The split is a condition on
    id and class: train and test are filters of the scan, not copies.
    """
    labelled = with_risk(df).where(F.col(S.RISK).isNotNull())
    split = stratified_split(labelled, row_id, S.RISK, test_fraction, params.seed)
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    model = fit_forest(train, S.RISK, features, params, row_id)
    context = [row_id if c == S.INCIDENT_ID else c for c in S.PREDICTION_CONTEXT]
    predictions = predict(model, test, context)
    importance = feature_importance(model, df.sparkSession)
    return RiskRun(model, train, test, predictions, importance)


def evaluate(
    predictions: DataFrame, training_rows: int | None = None, fitted_rows: int | None = None
) -> DataFrame:
    """All metrics of a prediction table in long form (metric, class, value).

    The table is read once, for the counts behind the confusion matrix. Given the rows that the
    model was trained on, and how many of them went into the trees, the table has them too.
    """
    matrix = pin(confusion_matrix(predictions))
    parts = [
        classification_report(matrix),
        balanced_accuracy(matrix).select(
            F.lit("balanced_accuracy").alias("metric"),
            F.lit("all").alias("class"),
            F.col("balanced_accuracy").alias("value"),
        ),
        matrix.select(
            F.concat(F.lit("confusion "), F.col("truth")).alias("metric"),
            F.col("predicted").alias("class"),
            F.col("n").cast("double").alias("value"),
        ),
        matrix.agg(F.sum("n").cast("double").alias("value")).select(
            F.lit("testing_records").alias("metric"), F.lit("all").alias("class"), "value"
        ),
    ]
    given = {"training_records": training_rows, "fitted_records": fitted_rows}
    rows = [(name, "all", float(n)) for name, n in given.items() if n is not None]
    if rows:
        parts.append(predictions.sparkSession.createDataFrame(rows, S.METRICS))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table
