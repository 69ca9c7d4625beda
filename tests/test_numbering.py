from pyspark.sql import functions as F

from mishap.operators.encoding import category_counts, dictionary
from mishap.operators.numbering import numbered


def test_numbers_follow_the_keys(spark):
    df = spark.range(0, 5000, 1, 9).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a b"), F.hex("id").alias("s"))
    df = df.unionByName(df.limit(1).select(F.lit(None).cast("long").alias("a b"), F.lit("z").alias("s")))
    rows = numbered(df, ["a b", "s"], "at").collect()
    rows.sort(key=lambda r: r["at"])
    assert [r["at"] for r in rows] == list(range(5001))
    keys = [(r["a b"] is not None, r["a b"] or 0, r["s"]) for r in rows]
    assert keys == sorted(keys)
    assert numbered(df.limit(0), ["s"], "at").collect() == []


def test_dictionary(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 2), (None, 2), ("é", 10)], "s string, n int")
    found = dictionary(category_counts(df, ["s", "n"])).collect()
    assert {tuple(r) for r in found} == {
        ("s", "a", 1, 0), ("s", "b", 2, 1), ("s", "é", 1, 2), ("n", "1", 1, 0), ("n", "10", 1, 1), ("n", "2", 3, 2),
    }
    assert dictionary(category_counts(df.limit(0), ["s"])).collect() == []


def test_a_long_dictionary_is_made_in_parts(spark):
    df = spark.range(200_000).select(F.md5(F.col("id").cast("string")).alias("v"))
    found = dictionary(category_counts(df, ["v"]))
    totals = found.agg(F.count("*"), F.min("place"), F.max("place"), F.count_distinct("place")).first()
    assert tuple(totals) == (200_000, 0, 199_999, 200_000)
    assert found.select(F.spark_partition_id()).distinct().count() > 1
    late = found.where("place = 123456").first()
    assert found.where(F.col("value") < late["value"]).count() == 123_456
