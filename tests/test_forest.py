import os
import subprocess
import sys

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from mishap.operators.encoding import category_counts, class_weights, modes
from mishap.operators.forest import (
    FEATURES,
    FeatureSet,
    ForestParams,
    class_quotas,
    draw,
    feature_importance,
    fit_forest,
    load_model,
    predict,
    preprocessor,
    save_model,
    training_medians,
    training_profile,
    vector_to_array,
)

PARAMS = ForestParams(trees=5, max_depth=3, exact_medians=True)
SET = FeatureSet(numeric=("n", "empty"), categorical=("color",), binary=("flag",))
SCHEMA = "id int, n double, empty double, color string, flag boolean, label string"


@pytest.fixture(scope="module")
def train(spark):
    rows = [
        (i, float(i) if i % 4 else None, None, ["red", "it's", None][i % 3], [True, None, False][i % 3], "ab"[i >= 30])
        for i in range(60)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_modes_prefer_the_least_of_equals(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 2), ("a", 1), (None, 2)], "s string, n int")
    got = {r["column"]: r["value"] for r in modes(category_counts(df, ["s", "n"])).collect()}
    assert got == {"s": "a", "n": "2"}


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] + [(None,)], "label string")
    counts = category_counts(df, ["label"])
    got = {r["value"]: r["weight"] for r in class_weights(counts).collect()}
    assert got == {"a": 4 / (2 * 3), "b": 4 / (2 * 1)}


def test_preprocessing(spark, train):
    prepare, names = preprocessor(train, SET, PARAMS, training_profile(train, SET, PARAMS))
    listed = names.orderBy("position").collect()
    assert [r["position"] for r in listed] == list(range(len(listed)))
    assert [r["feature"] for r in listed] == ["numerical__n", "categorical__color_it's", "categorical__color_red", "binary__flag"]
    new = spark.createDataFrame(
        [(1, None, 1.0, "green", None, None), (2, 2.5, None, None, True, None)], SCHEMA
    )
    rows = prepare.transform(new).select("id", vector_to_array(FEATURES).alias("v")).collect()
    vectors = {r["id"]: r["v"] for r in rows}
    kept = sorted(float(i) for i in range(60) if i % 4)
    median = (kept[(len(kept) - 1) // 2] + kept[len(kept) // 2]) / 2
    assert vectors[1] == [median, 0.0, 0.0, 0.0]
    assert vectors[2] == [2.5, 1.0, 0.0, 1.0]


def test_forest(spark, train, tmp_path):
    model = fit_forest(train, "label", SET, PARAMS)
    assert model.classes == ["a", "b"] and model.weights == {"a": 1.0, "b": 1.0}
    got = predict(model, train, ["id", "label"])
    assert got.columns == ["id", "label", "Predicted_Risk", "Probability_a", "Probability_b"]
    assert got.where("abs(Probability_a + Probability_b - 1) > 1e-9").count() == 0
    assert got.where("label = Predicted_Risk").count() > 50
    importance = feature_importance(model, spark)
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert importance.first()["feature"] == "numerical__n"
    assert (model.training_rows, model.fitted_rows) == (60, 60)
    path = str(tmp_path / "model")
    model.pipeline.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(train).select("id", "Predicted_Risk")
    assert sorted(again.collect()) == sorted(got.select("id", "Predicted_Risk").collect())


def test_quotas_are_equal_shares_of_the_limit():
    assert class_quotas({"a": 5, "b": 1000, "c": 1000}, 105) == {"a": 5, "b": 50, "c": 50}
    assert class_quotas({"a": 900, "b": 900}, 101) == {"a": 50, "b": 51}
    assert class_quotas({"a": 3, "b": 2}, 100) == {"a": 3, "b": 2}


@pytest.fixture(scope="module")
def many(spark):
    """Class b is rare; x tells the classes apart."""
    rare = F.col("id") % 20 == 0
    return spark.range(0, 4000, 1, 6).select(
        "id",
        F.when(rare, "b").otherwise("a").alias("label"),
        (F.when(rare, 1.0).otherwise(0.0) + F.col("id") % 7 / 10).alias("n"),
        F.lit(None).cast("double").alias("empty"),
        F.concat(F.lit("v"), F.col("id") % 300).alias("color"),
        (F.col("id") % 2 == 0).alias("flag"),
    )


@pytest.mark.parametrize("row_id", ["id", None])
def test_drawn_rows_are_bounded(spark, many, row_id):
    sizes = {"a": 3800, "b": 200}
    drawn, taken = draw(many, "label", row_id, sizes, 500, 42)
    assert taken == {"a": 300, "b": 200} and drawn.columns == many.columns
    assert {tuple(r) for r in drawn.groupBy("label").count().collect()} == {("a", 300), ("b", 200)}
    same, _ = draw(many.repartition(3), "label", row_id, sizes, 500, 42)
    assert drawn.exceptAll(same).isEmpty()
    whole, taken = draw(many, "label", row_id, sizes, 4000, 42)
    assert whole is many and taken == sizes


def test_forest_of_drawn_rows(spark, many, monkeypatch):
    """Fewer rows are held, they weigh as much as all, and the model still tells the classes apart."""
    import mishap.operators.forest as module

    seen = {}
    real = module.RandomForestClassifier.fit

    def spy(self, vectors, *args):
        seen["rows"] = {tuple(r) for r in vectors.groupBy("_label", "_weight").count().collect()}
        return real(self, vectors, *args)

    monkeypatch.setattr(module.RandomForestClassifier, "fit", spy)
    params = ForestParams(trees=5, max_depth=4, max_training_rows=400)
    model = fit_forest(many, "label", SET, params, "id")
    assert (model.training_rows, model.fitted_rows) == (4000, 400)
    # Both classes weigh half of the table, as with all rows.
    assert {(c, n) for c, _, n in seen["rows"]} == {(0.0, 200), (1.0, 200)}
    assert {round(w * n, 6) for _, w, n in seen["rows"]} == {2000.0}
    assert predict(model, many, ["label"]).where("label <> Predicted_Risk").count() < 40


def test_tasks_of_the_fit_do_not_follow_the_table(spark, many, monkeypatch):
    from mishap.operators import forest

    seen = []
    fit = forest.RandomForestClassifier.fit

    def counted(self, rows):
        seen.append((rows.rdd.getNumPartitions(), rows.count()))
        return fit(self, rows)

    monkeypatch.setattr(forest.RandomForestClassifier, "fit", counted)
    for parts in (40, 7):
        params = ForestParams(trees=2, max_depth=2, max_training_rows=100)
        fit_forest(many.repartition(parts), "label", SET, params, "id")
    assert seen == [(forest.TRAINING_TASKS, 100)] * 2


def test_medians_over_classes(spark, many):
    params = ForestParams()
    profile = training_profile(many, SET, params, "label")
    found = training_medians(many, SET, params, profile)
    exact = training_medians(many, SET, ForestParams(exact_medians=True), profile)
    assert found["empty"] is None and exact["empty"] is None
    assert abs(found["n"] - exact["n"]) < 0.11
    kinds = profile.select("column", "value", F.col("sketch").isNull().alias("counted"))
    classes = {r["value"] for r in kinds.where("column = 'n'").collect()}
    assert classes == {"a", "b"} and kinds.where("column = 'n' and counted").isEmpty()


def test_long_columns_are_looked_up(spark, many):
    """No list of values on the driver, the same vectors."""
    new = many.limit(50).unionByName(many.limit(1).withColumn("color", F.lit("unseen")))
    vectors, names = [], []
    for listed in (0, 1000):
        params = ForestParams(max_listed=listed, exact_medians=True)
        prepare, features = preprocessor(many, SET, params, training_profile(many, SET, params))
        kinds = [type(s).__name__ for s in prepare.stages]
        assert ("StringIndexerModel" in kinds) == (listed > 0)
        rows = prepare.transform(new).select("id", "color", vector_to_array(FEATURES).alias("v")).collect()
        vectors.append(sorted(map(tuple, rows)))
        names.append(sorted(map(tuple, features.collect())))
    assert vectors[0] == vectors[1] and names[0] == names[1] and len(names[0]) == 302
    assert all(len(v) == 302 for _, _, v in vectors[0])


LATER = """
import sys
from pyspark.sql import SparkSession
from mishap.operators.forest import feature_importance, load_model, predict
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
model = load_model(spark, sys.argv[1])
predict(model, spark.read.parquet(sys.argv[2]), ["id", "label"]).write.parquet(sys.argv[3])
feature_importance(model, spark).write.parquet(sys.argv[3] + "-importance")
"""


@pytest.mark.parametrize("listed", [0, 1000])
def test_a_saved_model_predicts_in_another_process(spark, many, tmp_path, listed):
    params = ForestParams(trees=3, max_depth=3, max_listed=listed)
    model = fit_forest(many, "label", SET, params, "id")
    rows, saved, moved, out = (str(tmp_path / n) for n in ("rows", "saved", "moved", "out"))
    many.write.parquet(rows)
    want = sorted(map(tuple, predict(model, many, ["id", "label"]).collect()))
    scores = sorted(map(tuple, feature_importance(model, spark).collect()))
    save_model(model, saved)
    # The folder may move, and what the fit wrote for itself may be gone.
    os.rename(saved, moved)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", LATER, moved, rows, out], check=True, cwd=root, timeout=240)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == want
    assert sorted(map(tuple, spark.read.parquet(out + "-importance").collect())) == scores
    again = load_model(spark, moved)
    assert (again.classes, again.weights) == (model.classes, model.weights)
    assert (again.training_rows, again.fitted_rows) == (4000, 4000)
