import pytest
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.operators.aggregates import best_by, dense_counts, top_values
from mishap.plans import reports

# Recorded silhouette scores per k.
SCORES = [
    (3, 0.622971234883497),
    (4, 0.7217646133898744),
    (5, 0.9635418709169387),
    (6, 0.8873832889434395),
    (7, 0.8598135771078455),
    (8, 0.8311830758096725),
]


def test_recorded_scores_select_five(spark):
    scores = spark.createDataFrame(SCORES, S.EVALUATION)
    assert best_by(scores, "silhouette_score", "k").first()["k"] == 5
    curve = reports.evaluation_curve(scores).collect()
    assert [r["k"] for r in curve if r["selected"]] == [5]


def test_equal_scores_select_the_smaller_k(spark):
    scores = spark.createDataFrame([(4, 0.5), (3, 0.5), (5, 0.1)], S.EVALUATION)
    assert best_by(scores, "silhouette_score", "k").first()["k"] == 3


def test_dense_counts(spark):
    df = spark.createDataFrame([("High",), ("High",), ("Odd",), (None,)], "r string")
    got = [tuple(r) for r in dense_counts(df, "r", ["Low", "Medium", "High"]).collect()]
    assert got == [("Low", 0), ("Medium", 0), ("High", 2)]


def test_top_values_break_ties_and_show_ascending(spark):
    df = spark.createDataFrame([(v,) for v in "aabbccd"] + [(None,)], "v string")
    assert [tuple(r) for r in top_values(df, "v", 2).collect()] == [("b", 2), ("a", 2)]


def test_top_features_strip_every_prefix(spark):
    rows = [("binary__Stop", 0.2), ("numerical__Start_Lng", 0.5), ("categorical__Wind_Direction_Calm", 0.3)]
    shown = reports.top_features(spark.createDataFrame(rows, S.IMPORTANCE), 2).collect()
    assert [r["display_feature"] for r in shown] == ["Wind Direction Calm", "Start Lng"]
    every = reports.top_features(spark.createDataFrame(rows, S.IMPORTANCE)).collect()
    assert every[0]["display_feature"] == "Stop"


def test_metrics_fall_back_to_defaults(spark):
    some = spark.createDataFrame([("accuracy", "all", 0.9), ("precision", "Low", 0.1)], S.METRICS)
    got = {r["metric"]: r["value"] for r in reports.headline_metrics(some, some).collect()}
    assert got == {"balanced_accuracy": None, "accuracy": 0.9, "testing_records": None}
    given = {"accuracy": 0.5, "balanced_accuracy": 0.25}
    shown = {r["metric"]: r["value"] for r in reports.headline_metrics(None, some, given).collect()}
    assert shown == {"balanced_accuracy": 0.25, "accuracy": 0.5, "testing_records": None}


def test_kpis(spark):
    clustered = spark.createDataFrame([(0,), (0,), (2,)], "cluster_id int")
    scores = spark.createDataFrame(SCORES, S.EVALUATION)
    row = reports.kpis(clustered, scores).first()
    assert (row["analyzed_incidents"], row["identified_hotspots"], row["best_k"]) == (3, 2, 5)
    assert row["best_silhouette"] == pytest.approx(0.9635418709169387)
    assert row["balanced_accuracy"] is None and row["testing_records"] is None


def test_cluster_filter(spark):
    df = spark.range(6).select((F.col("id") % 3).cast("int").alias("cluster_id"))
    assert reports.in_cluster(df, 1).count() == 2
    assert reports.in_cluster(df).count() == 6
    assert [r[0] for r in reports.cluster_choices(df).collect()] == [0, 1, 2]
