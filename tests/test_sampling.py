import math

import pytest
from pyspark.sql import functions as F

from mishap.operators import sampling
from mishap.operators.sampling import exact_sample, hashed_order, stratified_split


def labelled(spark, n):
    label = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 997 == 1, "rare").otherwise("cold")
    return spark.range(n).select("id", label.alias("label"))


def expected_test_rows(df):
    """Ids in the test part, by sorting every class."""
    rows = df.select("id", "label", hashed_order("id").alias("key")).collect()
    classes = {}
    for r in rows:
        classes.setdefault(r["label"], []).append((r["key"], r["id"]))
    total = len(rows)
    train = total - math.ceil(total * 0.2)
    whole = {c: len(v) * train // total for c, v in classes.items()}
    left = sorted(classes, key=lambda c: (-(len(classes[c]) * train % total), c))
    for c in left[: train - sum(whole.values())]:
        whole[c] += 1
    return {i for c, v in classes.items() for _, i in sorted(v)[: len(v) - whole[c]]}


@pytest.mark.parametrize("n,tail", [(5, 1_000_000), (4001, 1_000_000), (4001, 3), (4001, 1)])
def test_split_is_exact(spark, monkeypatch, n, tail):
    monkeypatch.setattr(sampling, "TAIL_ROWS", tail)
    df = labelled(spark, n)
    split = stratified_split(df, "id", "label").collect()
    assert len(split) == n
    assert {r["id"] for r in split if r["split"] == "test"} == expected_test_rows(df)


def test_split_is_exact_for_repeated_and_missing_ids(spark):
    """1,000 rows of one class give 200 test rows, whatever their ids."""
    rows = spark.range(1000).withColumn("label", F.lit("a"))
    for ids in (F.col("id") % 3, F.lit(None).cast("long"), F.lit(7)):
        for other in (F.col("id"), F.lit(0)):
            df = rows.select(ids.alias("key"), other.alias("other"), "label")
            split = stratified_split(df, "key", "label")
            assert split.where("split = 'test'").count() == 200
            assert split.drop("split").exceptAll(df).isEmpty() and split.count() == 1000


def test_split_with_a_shuffled_lookup(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = labelled(spark, 3000)
        split = stratified_split(df, "id", "label").where("split = 'test'").collect()
        assert {r["id"] for r in split} == expected_test_rows(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_split_does_not_depend_on_partitions(spark):
    df = labelled(spark, 2000)
    parts = [
        {r["id"] for r in stratified_split(df.repartition(p), "id", "label").where("split='test'").collect()}
        for p in (1, 7)
    ]
    assert parts[0] == parts[1]


@pytest.mark.parametrize("limit", [0, 1, 100, 5000])
def test_sample_is_first_in_hashed_order(spark, limit):
    df = spark.range(3000)
    got = [r["id"] for r in exact_sample(df, "id", limit).collect()]
    want = [r["id"] for r in df.orderBy(hashed_order("id")).limit(limit).collect()]
    assert sorted(got) == sorted(want) and len(got) == min(limit, 3000)


def test_sample_with_one_repeated_id(spark, monkeypatch):
    monkeypatch.setattr(sampling, "TAIL_ROWS", 3)
    df = spark.range(500).select(F.lit(7).alias("id"))
    assert exact_sample(df, "id", 20).count() == 20


def test_sample_of_nothing(spark):
    assert exact_sample(spark.range(0), "id", 10).count() == 0


@pytest.mark.parametrize("salts", [1, 7, 256])
def test_equal_rows_are_shared_out_to_salts(spark, salts):
    rows = spark.range(0, 3000, 1, 11).select(
        (F.col("id") % 3).alias("g"), F.lit("x").alias("v"), (F.col("id") % 3 * 400).alias("_need")
    )
    got = sampling.pick_equal(rows, ["g"], salts).groupBy("g").agg(F.count_if("_picked").alias("n"), F.count("*").alias("all"))
    assert {tuple(r) for r in got.collect()} == {(0, 0, 1000), (1, 400, 1000), (2, 800, 1000)}


def test_least_hashed_of_every_group(spark):
    df = spark.range(0, 4000, 1, 13).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("g"))
    got = sampling.least_hashed(df, "id", "g", 60).collect()
    for group in (None, 1, 2, 3, 4):
        rows = df.where(F.col("g").eqNullSafe(F.lit(group))).orderBy(hashed_order("id")).limit(60).collect()
        assert sorted(r["id"] for r in got if r["g"] == group) == sorted(r["id"] for r in rows)
    whole = sampling.least_hashed(df, "id", None, 100).collect()
    assert sorted(whole) == sorted(df.orderBy(hashed_order("id")).limit(100).collect())


def test_least_hashed_of_repeated_rows(spark):
    df = spark.range(0, 900, 1, 7).select(F.lit(1).alias("id"), F.lit("a").alias("g"))
    assert sampling.least_hashed(df, "id", "g", 50).count() == 50
    assert sampling.least_hashed(df, "id", "g", 5000).count() == 900
    assert sampling.least_hashed(df.limit(0), "id", "g", 50).count() == 0
