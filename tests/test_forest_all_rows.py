import pytest
from pyspark.sql import functions as F

from checks import catalog
from mishap import schemas as S
from mishap.operators import forest
from mishap.sources.tables import stage

QUERIES = ["kpis", "risk_metrics", "risk_model_holds", "risk_predictions"]


class Fitted(Exception):
    pass


@pytest.fixture(scope="module")
def many_incidents(spark):
    """400,000 incidents of three risk classes: 8,000 Low, 261,333 Medium and 130,667 High."""
    i = F.col("id")
    severity = F.when(i % 50 == 0, 1).when(i % 3 == 0, 4).otherwise(2)
    made = {
        S.INCIDENT_ID: F.concat(F.lit("A-"), i.cast("string")),
        S.SEVERITY: severity,
        S.START_TIME: F.timestamp_seconds(i),
        "Start_Lat": i % 90,
        "State": F.when(severity == 4, "CA").otherwise("OH"),
        "Amenity": i % 2 == 0,
    }
    columns = [made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.ENGINEERED_SCHEMA.fields]
    return stage(spark.range(0, 400_000, 1, 8).select(*columns), "many")


@pytest.mark.parametrize("name", QUERIES)
def test_the_trees_get_all_training_rows(spark, many_incidents, monkeypatch, name):
    """Every training row goes into the fit with the balanced weight of its class; none are drawn."""

    def spy(self, vectors, *args):
        found = vectors.groupBy("_label").agg(F.count("*").alias("n"), F.collect_set("_weight").alias("w"))
        raise Fitted({r["_label"]: (r["n"], r["w"]) for r in found.collect()})

    monkeypatch.setattr(catalog, "staged_incidents", lambda spark, sf: many_incidents)
    monkeypatch.setattr(catalog.hotspots, "fit_hotspots", lambda df: None)
    monkeypatch.setattr(forest.RandomForestClassifier, "fit", spy)
    with pytest.raises(Fitted) as seen:
        catalog.QUERIES[name](spark, "")
    # High, Low, Medium: four fifths of each class, shared out by largest remainder.
    sizes = [104_534, 6_400, 209_066]
    assert {c: n for c, (n, _) in seen.value.args[0].items()} == {float(i): n for i, n in enumerate(sizes)}
    assert all(len(w) == 1 and w[0] * n == pytest.approx(320_000 / 3) for n, w in seen.value.args[0].values())
