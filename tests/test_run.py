import os

import pytest
from pyspark.sql import functions as F

from checks.standin import incidents
from mishap import schemas as S
from mishap.operators.forest import ForestParams
from mishap.plans import reports, run
from mishap.sources import results
from mishap.sources.tables import read_csv, read_table, release, stage, write_observed, write_table


def test_csv_is_typed_by_name(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        'Severity,Extra,ID,Start_Time,Start_Lat,Stop,Street\n'
        '2,x,A-1,2024-01-01 10:00:00.5,1.5,True,"Main ""St"", 5"\n'
        'n/a,y,A-2,soon,north,maybe,\n'
    )
    df = read_csv(spark, str(path))
    types = dict(df.dtypes)
    assert types["Severity"] == "int" and types["Start_Time"] == "timestamp" and types["Extra"] == "string"
    good, bad = df.orderBy("ID").collect()
    assert (good["Severity"], good["Stop"], good["Street"]) == (2, True, 'Main "St", 5')
    assert bad["Severity"] is None and bad["Start_Time"] is None
    assert bad["Start_Lat"] is None and bad["Stop"] is None


def test_csv_loses_nothing(spark, tmp_path):
    rows = [
        ("a", 'two\nlines "quoted", done', "2024-01-01 01:02:03.456789"),
        ("b", None, None),
        ("c", " pad ", "2024-12-31 23:59:59.000001"),
        ("d", "", "2024-01-01 00:00:00"),
        ("e", 'back\\slash"', "2024-01-01 00:00:00"),
    ]
    df = spark.createDataFrame(rows, "ID string, Street string, Start_Time string")
    df = df.withColumn("Start_Time", F.col("Start_Time").cast("timestamp"))
    path = str(tmp_path / "out.csv")
    write_table(df, path, order_by="ID", total_order=True)
    assert sorted(read_table(spark, path, df.schema).collect()) == sorted(df.collect())


def test_large_files_are_split(spark, tmp_path):
    path = str(tmp_path / "raw.csv")
    spark.range(200_000).select(F.col("id").cast("string").alias("ID"), F.lit("x" * 40).alias("Street")).coalesce(
        1
    ).write.csv(path, header=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        split, whole = (read_csv(spark, path, multiline=m).rdd.getNumPartitions() for m in (False, True))
        rows = read_csv(spark, path)
        assert split > 4 and whole == 1
        assert rows.count() == 200_000 and rows.select("ID").distinct().count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_observed_write(spark, tmp_path):
    df = spark.createDataFrame([(3, None), (1, "x"), (2, None)], "n int, s string").repartition(3)
    path = str(tmp_path / "t")
    for total in (False, True):
        seen = write_observed(df, path, order_by="n", total_order=total)
        assert seen == {"rows": 3, "cols": 2, "missing": {"s": 2}}
    assert sorted(read_table(spark, path).collect(), key=str) == sorted(df.collect(), key=str)


def test_stage_ends_the_lineage(spark):
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5 and len(staged.inputFiles()) > 0
    place = staged.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(place)
    release()
    assert not os.path.exists(place)


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    source = str(base / "raw.csv")
    write_table(incidents(spark, sf), source)
    out = str(base / "out")
    cleaned = run.run_cleaning(spark, source, out)
    engineered = run.run_engineering(spark, out)
    hot = run.run_hotspots(spark, out, counts=(3, 4))
    risk = run.run_risk(spark, out, params=ForestParams(trees=5, max_depth=4))
    return out, cleaned, engineered, hot, risk


def test_stages(spark, sf, folder):
    out, cleaned, engineered, hot, risk = folder
    rows = incidents(spark, sf).select("ID").distinct().count()
    assert cleaned["rows"] == engineered["rows"] == hot["rows"] == rows
    assert not set(cleaned["missing"]) & set(S.LABELLED + S.MEASURED)
    assert hot["best_k"] in (3, 4) and hot["skipped_rows"] == 0
    assert engineered["cols"] == 36 and hot["cols"] == 37
    assert risk["training_records"] + risk["testing_records"] == rows
    assert risk["testing_records"] == -(-rows // 5)


def test_result_tables(spark, folder):
    tables = results.load_results(spark, folder[0])
    assert tables.engineered is tables.clustered
    assert tables.clustered.schema.names == S.CLUSTERED_SCHEMA.names
    total = tables.hotspots.agg(F.sum("accident_count")).first()[0]
    assert total == tables.clustered.count()
    assert [r["k"] for r in tables.evaluation.orderBy("k").collect()] == [3, 4]
    assert tables.importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    shown = reports.first_predictions(tables.predictions).collect()
    assert len(shown) == 100 and [r["ID"] for r in shown] == sorted(r["ID"] for r in shown)
    assert tables.predictions.columns == S.PREDICTION_CONTEXT + [
        "Predicted_Risk",
        "Probability_High",
        "Probability_Low",
        "Probability_Medium",
    ]
    row = reports.kpis(tables.clustered, tables.evaluation, tables.metrics).first()
    assert row["testing_records"] == tables.predictions.count()
    assert sum(r["Count"] for r in reports.predicted_risk(tables.predictions).collect()) == row["testing_records"]


def test_export(spark, folder, tmp_path):
    target = str(tmp_path / "csv")
    run.export_csv(spark, folder[0], target)
    tables = results.load_results(spark, folder[0])
    clustered = read_table(spark, f"{target}/{results.CLUSTERED}.csv", S.CLUSTERED_SCHEMA)
    assert clustered.schema.names == S.CLUSTERED_SCHEMA.names
    assert clustered.exceptAll(tables.clustered).count() == 0
    assert clustered.count() == tables.clustered.count()
    scores = read_table(spark, f"{target}/{results.EVALUATION}.csv", S.EVALUATION)
    assert scores.collect() == tables.evaluation.collect()
