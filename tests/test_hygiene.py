import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.operators.hygiene import (
    dedup,
    fill_constant,
    fill_numbers,
    medians,
    missing_report,
    schema_listing,
    stage_profile,
)
from mishap.plans.cleaning import clean

NAN = float("nan")


def plan_of(df):
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


def test_dedup_keeps_least_row_and_merges_missing_keys(spark):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, None), (None, 5, "p"), (None, 4, "q"), ("b", 1, "y")]
    df = spark.createDataFrame(rows, "ID string, v int, s string")
    expected = {("a", 1, None), (None, 4, "q"), ("b", 1, "y")}
    for parts in (1, 3):
        assert {tuple(r) for r in dedup(df.repartition(parts), ["ID"]).collect()} == expected


def test_dedup_drops_copies_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = plan_of(dedup(df.repartition(4), ["k"]))
    assert "Partial" in plan and "WindowGroupLimit" in plan


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3))), min_size=1))
def test_dedup_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    once = dedup(df, ["k"])
    assert sorted(map(str, once.collect())) == sorted(map(str, dedup(once, ["k"]).collect()))
    assert once.count() == len({k for k, _ in rows})


def test_medians_ignore_gaps(spark):
    rows = [(1.0, None, NAN), (2.0, None, 7.0), (3.0, None, None), (NAN, None, 9.0), (None, None, 8.0)]
    df = spark.createDataFrame(rows, "a double, b double, `c(x)` double")
    row = medians(df, df.columns)
    assert row.first().asDict() == {"a": 2.0, "b": None, "c(x)": 8.0}
    filled = fill_numbers(df, df.columns, row)
    assert filled.where("isnan(a) or a is null or isnan(`c(x)`)").count() == 0
    assert filled.where("b is not null").count() == 0
    same = fill_numbers(df, df.columns, row.first().asDict())
    assert sorted(map(str, same.collect())) == sorted(map(str, filled.collect()))


@pytest.mark.parametrize("parts", [1, 5, 100])
def test_medians_stay_within_the_error(spark, parts):
    """Partitions that hold different ranges and sizes still give the middle of the whole."""
    df = spark.range(0, 20_000, 1, parts).select(
        (F.col("id") * 1.0).alias("a"),
        F.when(F.col("id") < 7000, 5.0).otherwise(F.col("id")).alias("b"),
        F.when(F.col("id") < 300, F.col("id") * 1.0).alias("c"),
    )
    got = medians(df, df.columns, 0.01).first()
    for column, rows in [("a", 20_000), ("b", 20_000), ("c", 300)]:
        below = df.where(F.col(column) < got[column]).count()
        upto = df.where(F.col(column) <= got[column]).count()
        assert below <= 0.51 * rows + 1 and upto >= 0.49 * rows - 1


def test_integer_column_takes_truncated_fill(spark):
    df = spark.createDataFrame([(None,), (4,)], "n int")
    assert {r[0] for r in fill_numbers(df, ["n"], {"n": 2.7}).collect()} == {2, 4}


def test_constant_fill_and_missing_report(spark):
    df = spark.createDataFrame([("a", None, 1), (None, None, 2)], "s string, t string, n int")
    assert {tuple(r) for r in missing_report(df).collect()} == {("s", 1), ("t", 2)}
    filled = fill_constant(df, ["s", "t"])
    assert missing_report(filled).count() == 0
    assert filled.where("s = 'Unknown'").count() == 1


def test_profile_and_schema(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert tuple(stage_profile(df, "raw").first()) == ("raw", 1, 2)
    assert [tuple(r) for r in schema_listing(df).orderBy("position").collect()] == [
        (0, "n", "int"),
        (1, "s", "string"),
    ]


def test_clean_reads_and_shuffles_the_input_once(spark, sf):
    raw = spark.read.parquet(f"{sf}/lineitem.parquet").withColumnsRenamed(
        {"l_quantity": "Temperature(F)", "l_tax": "Humidity(%)", "l_returnflag": "Timezone"}
    )
    keyed = raw.withColumn("ID", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    cleaned = clean(keyed)
    final = plan_of(cleaned)
    assert "ReusedExchange" in final and "ReusedSubquery" in final
    assert cleaned.count() == keyed.select("ID").distinct().count()


@pytest.mark.parametrize("missing", ["End_Lat", "Wind_Chill(F)"])
def test_clean_drops_columns(spark, missing):
    df = spark.createDataFrame([("a", 1.0)], ["ID", missing])
    assert clean(df).columns == ["ID"]


@pytest.mark.parametrize("name", ["cleaned_incidents", "engineered_incidents"])
def test_raw_rows_are_made_and_shuffled_once(spark, monkeypatch, name):
    from checks import catalog

    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def street(i):
        calls.add(1)
        return f"Street {i}"

    def raw(spark, sf):
        fixed = {"ID": F.concat(F.lit("a"), F.col("id") % 30), "Street": street("id"), "Humidity(%)": F.col("id")}
        columns = [fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.RAW.fields]
        return spark.range(40, numPartitions=2).select(*columns)

    monkeypatch.setattr(catalog.standin, "incidents", raw)
    rows = catalog.QUERIES[name](spark, "").collect()
    assert sorted(r["ID"] for r in rows) == sorted(f"a{i}" for i in range(30))
    assert calls.value == 40
