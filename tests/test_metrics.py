import pytest
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.operators.metrics import balanced_accuracy, classification_report, confusion_matrix

# A recorded confusion matrix in class order, and the figures reported for it.
GOLDEN = [[0, 13, 7], [1, 8165, 2839], [0, 1722, 7253]]
REPORTED = {
    ("precision", "Low"): 0.00,
    ("recall", "Low"): 0.00,
    ("f1", "Low"): 0.00,
    ("support", "Low"): 20,
    ("precision", "Medium"): 0.82,
    ("recall", "Medium"): 0.74,
    ("f1", "Medium"): 0.78,
    ("support", "Medium"): 11005,
    ("precision", "High"): 0.72,
    ("recall", "High"): 0.81,
    ("f1", "High"): 0.76,
    ("support", "High"): 8975,
    ("precision", "macro avg"): 0.51,
    ("recall", "macro avg"): 0.52,
    ("f1", "macro avg"): 0.51,
    ("precision", "weighted avg"): 0.78,
    ("recall", "weighted avg"): 0.77,
    ("f1", "weighted avg"): 0.77,
    ("accuracy", "all"): 0.77,
}


@pytest.fixture(scope="module")
def golden(spark):
    pairs = [
        (t, p, n)
        for t, row in zip(S.RISK_CLASSES, GOLDEN)
        for p, n in zip(S.RISK_CLASSES, row)
        if n
    ]
    counted = spark.createDataFrame(pairs, [S.RISK, S.PREDICTED_RISK, "n"])
    return confusion_matrix(counted.selectExpr("*", "explode(sequence(1, n)) AS i"))


def test_confusion_matrix_keeps_order_and_empty_cells(golden):
    assert [r["n"] for r in golden.collect()] == [n for row in GOLDEN for n in row]


def test_report(golden):
    got = {(r["metric"], r["class"]): r["value"] for r in classification_report(golden).collect()}
    for key, value in REPORTED.items():
        assert round(got[key], 2) == value
    assert got[("accuracy", "all")] == pytest.approx(0.7709)
    assert got[("support", "macro avg")] == 20000


def test_balanced_accuracy(golden):
    assert balanced_accuracy(golden).first()[0] == pytest.approx(0.5167, abs=5e-5)


def test_absent_class_does_not_lower_balanced_accuracy(spark):
    df = spark.createDataFrame([("High", "High"), ("Medium", "High")], [S.RISK, S.PREDICTED_RISK])
    assert balanced_accuracy(confusion_matrix(df)).first()[0] == 0.5
    report = {(r[0], r[1]): r[2] for r in classification_report(confusion_matrix(df)).collect()}
    assert report[("f1", "Low")] == 0.0 and report[("precision", "Medium")] == 0.0


def test_each_row_is_predicted_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def predicted(i):
        calls.add(1)
        return [*S.RISK_CLASSES, "Other", None][i % 5]

    rows = spark.range(50, numPartitions=2).withColumn(S.RISK, F.lit("Low"))
    matrix = confusion_matrix(rows.withColumn(S.PREDICTED_RISK, predicted("id")))
    cells = {(r["truth"], r["predicted"]): r["n"] for r in matrix.collect()}
    assert cells == {(t, p): 10 if t == "Low" else 0 for t in S.RISK_CLASSES for p in S.RISK_CLASSES}
    assert calls.value == 50
