import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from mishap.operators.aggregates import hotspot_summary
from mishap.operators.clustering import (
    WEIGHT,
    as_points,
    as_vectors,
    assign_clusters,
    fit_scaling,
    scaled_points,
    silhouette,
    standardise,
    sweep,
)
from mishap.plans.hotspots import fit_hotspots

XY = ["x", "y"]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    centres = [(0.0, 0.0), (10.0, 0.0), (0.0, 30.0)]
    rows = [
        (i * 100 + j, float(cx + rng.normal()), float(cy + rng.normal()), i)
        for i, (cx, cy) in enumerate(centres)
        for j in range(100)
    ]
    return spark.createDataFrame(rows, "id long, x double, y double, c int").repartition(3).persist()


def test_standardise_matches_the_library_scaler(spark, blobs):
    vectors = VectorAssembler(inputCols=XY, outputCol="v").transform(blobs)
    model = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vectors)
    scaled = model.transform(vectors).select("id", vector_to_array("s").alias("s"))
    want = {r["id"]: r["s"] for r in scaled.collect()}
    for r in standardise(blobs, XY).collect():
        assert [r["x"], r["y"]] == pytest.approx(want[r["id"]], abs=1e-12)


def test_feature_without_spread_becomes_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], XY)
    assert {r["y"] for r in standardise(df, XY).collect()} == {0.0}


def test_silhouette_matches_the_library_evaluator(spark, blobs):
    mixed = blobs.withColumn("c", F.when(F.col("id") % 10 == 0, (F.col("c") + 1) % 3).otherwise(F.col("c")))
    vectors = VectorAssembler(inputCols=XY, outputCol="v").transform(mixed)
    want = ClusteringEvaluator(featuresCol="v", predictionCol="c").evaluate(vectors)
    assert silhouette(mixed, XY, "c").first()[0] == pytest.approx(want, abs=1e-12)


def test_silhouette_of_weighted_points_equals_repeated_points(spark):
    rows = [(0.0, 0.0, 0, 3), (1.0, 0.0, 0, 1), (5.0, 5.0, 1, 2), (6.0, 5.0, 1, 4), (9.0, 9.0, 2, 1)]
    df = spark.createDataFrame(rows, "x double, y double, c int, n int")
    repeated = df.withColumn("i", F.explode(F.sequence(F.lit(1), "n")))
    merged = silhouette(df, XY, "c", weight="n").first()[0]
    assert merged == pytest.approx(silhouette(repeated, XY, "c").first()[0], abs=1e-12)


def test_silhouette_of_text_clusters(spark, blobs):
    mixed = blobs.withColumn("c", F.concat(F.lit("it's "), F.col("id") % 7))
    vectors = VectorAssembler(inputCols=XY, outputCol="v").transform(
        mixed.withColumn("i", F.col("id") % 7)
    )
    want = ClusteringEvaluator(featuresCol="v", predictionCol="i").evaluate(vectors)
    assert silhouette(mixed, XY, "c").first()[0] == pytest.approx(want, abs=1e-12)


def test_many_clusters(spark):
    """As many clusters as half of the rows: pairs at distance 1, clusters far apart."""
    df = spark.range(4000).select(
        (F.col("id") % 2000 * 100 + F.floor(F.col("id") / 2000)).cast("double").alias("x"),
        F.lit(0.0).alias("y"),
        (F.col("id") % 2000).alias("c"),
    )
    assert silhouette(df, XY, "c").first()[0] == pytest.approx(0.9999, abs=1e-4)


def test_clusters_do_not_depend_on_how_the_input_is_dealt(spark, blobs):
    found = [fit_hotspots(blobs.repartition(n), XY, counts=[3, 5]) for n in (1, 7)]
    for k in (3, 5):
        assert np.allclose(found[0].centres[k], found[1].centres[k], atol=1e-12)


def test_sweep_scores_match_the_library(spark, blobs):
    scaling = fit_scaling(blobs, XY)
    vectors = as_vectors(scaled_points(blobs, XY, scaling), XY).persist()
    evaluator = ClusteringEvaluator(predictionCol="prediction")
    for k, (centres, score) in sweep(vectors, XY, [2, 3]).items():
        model = KMeans(k=k, seed=42, maxIter=20, weightCol=WEIGHT).fit(vectors)
        assert np.allclose(sorted(c.tolist() for c in model.clusterCenters()), centres)
        assert score == pytest.approx(evaluator.evaluate(model.transform(vectors)), abs=1e-9)
    vectors.unpersist()


def test_silhouette_edge_cases(spark):
    one = spark.createDataFrame([(0.0, 0.0, 0), (1.0, 1.0, 0)], "x double, y double, c int")
    assert silhouette(one, XY, "c").first()[0] == 0.0
    single = spark.createDataFrame([(0.0, 0.0, 0), (1.0, 1.0, 1)], "x double, y double, c int")
    assert silhouette(single, XY, "c").first()[0] == 0.0


def test_assignment_matches_the_library_model(spark, blobs):
    vectors = VectorAssembler(inputCols=XY, outputCol="features").transform(blobs)
    model = KMeans(k=3, seed=1).fit(vectors)
    want = {r["id"]: r["prediction"] for r in model.transform(vectors).collect()}
    got = assign_clusters(blobs, XY, [list(c) for c in model.clusterCenters()])
    assert {r["id"]: r["cluster_id"] for r in got.collect()} == want


def test_merged_points_keep_the_scores(spark, blobs):
    """Points that repeat are merged; scores equal those of the points one by one."""
    coarse = blobs.select("id", F.round("x").alias("x"), F.round("y").alias("y"))
    many = coarse.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(4))))
    scaling = fit_scaling(many, XY)
    merged = scaled_points(many, XY, scaling)
    assert merged.count() < many.count() / 2
    assert merged.agg(F.sum(WEIGHT)).first()[0] == many.count()
    flat = many.select(*[scaling.scaled(f).alias(f) for f in XY], F.lit(1.0).alias(WEIGHT))
    centres = [[-1.0, 0.0], [0.0, 0.0], [1.0, 1.0]]
    a = silhouette(assign_clusters(merged, XY, centres), XY, "cluster_id", WEIGHT).first()[0]
    b = silhouette(assign_clusters(flat, XY, centres), XY, "cluster_id").first()[0]
    assert a == pytest.approx(b, abs=1e-9)
    back = as_points(as_vectors(merged, XY), XY)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, merged.collect()))


def test_hotspots_find_the_blobs(spark, blobs):
    found = fit_hotspots(blobs, XY, counts=range(3, 6))
    assert found.best_k == 3 and found.skipped_rows == 0
    placed = found.assign(blobs)
    assert placed.groupBy("c").agg(F.count_distinct("cluster_id")).where("`count(DISTINCT cluster_id)` <> 1").count() == 0
    again = fit_hotspots(blobs, XY, counts=range(3, 6))
    assert again.centres == found.centres
    sizes = [r["accident_count"] for r in hotspot_summary(placed, severity="x", lat="x", lng="y").collect()]
    assert sizes == [100, 100, 100]


def test_rows_without_a_feature_stay_without_a_cluster(spark, blobs):
    gap = spark.createDataFrame([(900, None, 1.0, 0), (901, float("nan"), 1.0, 0)], blobs.schema)
    found = fit_hotspots(blobs.union(gap), XY, counts=[3])
    placed = found.assign(blobs.union(gap))
    assert found.skipped_rows == 2 and placed.count() == 302
    assert {r["id"] for r in placed.where("cluster_id is null").collect()} == {900, 901}
