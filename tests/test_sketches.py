import re

import pytest
from pyspark.sql import functions as F

from mishap.operators.hygiene import medians
from mishap.operators.sketches import median, merge, sketch_size, sketches
from mishap.plans.cleaning import clean
from tests.test_hygiene import plan_of


def test_size_grows_with_the_accuracy():
    assert 8 <= sketch_size(0.5) < sketch_size(0.01) < sketch_size(0.001) <= 65_535
    assert sketch_size(1e-9) == 65_535


def test_sketches_of_groups_merge_to_the_whole(spark):
    df = spark.range(0, 90_000, 1, 40).select(
        (F.col("id") % 3).alias("class"),
        F.when(F.col("id") % 10 > 0, F.col("id")).alias("a b"),
        F.lit(None).cast("double").alias("none"),
    )
    per_class = sketches(df, ["a b", "none"], 0.01, ["class"])
    assert sorted(r["class"] for r in per_class.collect()) == [0, 1, 2]
    whole = per_class.agg(*[merge(F.col(s)).alias(s) for s in ("s0", "s1")])
    row = whole.select(median(F.col("s0")).alias("a"), median(F.col("s1")).alias("b")).first()
    assert row["b"] is None
    below = df.where(F.col("a b") < row["a"]).count()
    assert abs(below / 81_000 - 0.5) < 0.01
    for r in per_class.select("class", median(F.col("s0")).alias("m")).collect():
        one = df.where(F.col("class") == r["class"])
        assert abs(one.where(F.col("a b") < r["m"]).count() / 27_000 - 0.5) < 0.01


def test_no_values_at_all(spark):
    df = spark.range(0).select(F.col("id").cast("double").alias("x"))
    assert medians(df, ["x"]).collect()[0]["x"] is None
    assert sketches(df.withColumn("g", F.lit("a")), ["x"], 0.01, ["g"]).collect() == []


def test_small_tables_have_their_own_lower_median(spark):
    df = spark.createDataFrame([(4.0,), (1.0,), (3.0,), (2.0,)], "x double")
    assert medians(df, ["x"]).first()["x"] == 2.0


def test_task_sketches_do_not_meet_in_one_task(spark):
    """Between the tasks and the last merge stands an exchange by groups of tasks."""
    raw = spark.range(0, 5000, 1, 20).select(
        F.col("id").cast("string").alias("ID"), F.rand(1).alias("Temperature(F)"), F.rand(2).alias("Humidity(%)")
    )
    plan = plan_of(clean(raw))
    spans = re.findall(r"partial_kll_sketch_agg_double|partial_kll_merge_agg_double|Exchange \w+", plan)
    assert "partial_kll_sketch_agg_double" in spans
    # A partial sketch is dealt by hash; only merged ones go on to the single last task.
    for at, name in enumerate(spans):
        if name == "partial_kll_sketch_agg_double":
            before = [s for s in spans[:at] if s.startswith("Exchange")]
            assert before and before[-1] == "Exchange hashpartitioning", spans


@pytest.mark.parametrize("error", [0.01, 0.001])
def test_rank_error(spark, error):
    df = spark.range(0, 300_000, 1, 30).select(F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("x"))
    got = medians(df, ["x"], error).first()["x"]
    assert abs(df.where(F.col("x") < got).count() / 300_000 - 0.5) < error
