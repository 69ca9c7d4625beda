"""The four stages from and to written tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.operators.forest import FeatureSet, ForestParams, load_model, predict, save_model
from mishap.operators.joins import pin
from mishap.plans.cleaning import clean
from mishap.plans.engineering import engineer
from mishap.plans.hotspots import fit_hotspots, summarise
from mishap.plans.risk import evaluate, train_risk, with_risk
from mishap.sources import results as R
from mishap.sources.tables import read_csv, write_observed, write_small, write_table


def run_cleaning(
    spark: SparkSession, source: str, folder: str, multiline: bool = False
) -> dict:
    """Raw CSV to the cleaned table; returns its rows, columns and remaining missing values.

    Files are sorted by id, which deduplication has already done inside each task.
    """
    cleaned = clean(read_csv(spark, source, multiline=multiline))
    return write_observed(cleaned, f"{folder}/{R.CLEANED}", order_by=S.INCIDENT_ID)


def run_engineering(spark: SparkSession, folder: str) -> dict:
    """Cleaned to engineered table. A narrow pass: the order by id within files is kept."""
    cleaned = spark.read.parquet(f"{folder}/{R.CLEANED}")
    return write_observed(engineer(cleaned), f"{folder}/{R.ENGINEERED}")


def run_hotspots(spark: SparkSession, folder: str, counts=S.CLUSTER_COUNTS) -> dict:
    """Engineered to clustered table, with the evaluation of k and the hotspot summary."""
    engineered = spark.read.parquet(f"{folder}/{R.ENGINEERED}")
    found = fit_hotspots(engineered, counts=counts)
    written = write_observed(found.assign(engineered), f"{folder}/{R.CLUSTERED}")
    clustered = spark.read.parquet(f"{folder}/{R.CLUSTERED}")
    write_small(found.evaluation, f"{folder}/{R.EVALUATION}")
    write_small(summarise(clustered), f"{folder}/{R.HOTSPOTS}")
    return {**written, "best_k": found.best_k, "skipped_rows": found.skipped_rows}


def run_risk(
    spark: SparkSession,
    folder: str,
    features: FeatureSet = FeatureSet(),
    params: ForestParams = ForestParams(),
) -> dict:
    """Clustered table to predictions, metrics, feature importance and the saved model."""
    clustered = spark.read.parquet(f"{folder}/{R.CLUSTERED}")
    run = train_risk(clustered, features=features, params=params)
    write_table(run.predictions, f"{folder}/{R.PREDICTIONS}")
    predictions = spark.read.parquet(f"{folder}/{R.PREDICTIONS}")
    metrics = pin(evaluate(predictions, run.model.training_rows, run.model.fitted_rows))
    write_small(metrics, f"{folder}/{R.METRICS}")
    write_small(run.importance, f"{folder}/{R.IMPORTANCE}")
    save_model(run.model, f"{folder}/{R.MODEL}")
    headline = metrics.where(F.col("class") == "all").collect()
    return {row["metric"]: row["value"] for row in headline}


def run_prediction(spark: SparkSession, folder: str, source: str, target: str) -> dict:
    """Predict the rows of a clustered table with a folder's saved model, labelled or not."""
    clustered = spark.read.parquet(source)
    labelled = with_risk(clustered)
    model = load_model(spark, f"{folder}/{R.MODEL}")
    return write_observed(predict(model, labelled, S.PREDICTION_CONTEXT), target)


def export_csv(spark: SparkSession, folder: str, target: str) -> None:
    """The tables of a run as CSV: the large ones in order of id, the small ones as one file."""
    for name in [R.CLEANED, R.ENGINEERED, R.CLUSTERED, R.PREDICTIONS]:
        table = spark.read.parquet(f"{folder}/{name}")
        write_table(table, f"{target}/{name}.csv", order_by=S.INCIDENT_ID, total_order=True)
    for name in [R.EVALUATION, R.HOTSPOTS, R.METRICS, R.IMPORTANCE]:
        write_small(spark.read.parquet(f"{folder}/{name}"), f"{target}/{name}.csv")
