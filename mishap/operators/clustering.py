"""Standardising, assignment to centres, the silhouette score and k-means over a range of k."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.functions.labels import present
from mishap.operators.hygiene import quoted

# Merged points per task.
POINTS_PER_PARTITION = 20_000
WEIGHT = "_weight"


@dataclass(frozen=True)
class Scaling:
    """Mean and sample standard deviation of each feature over the complete rows."""

    mean: Mapping[str, float]
    sd: Mapping[str, float]
    rows: int
    complete_rows: int
    distinct_rows: int

    def scaled(self, feature: str) -> Column:
        """(x - mean) / sd; a feature without spread becomes 0 where it is present."""
        value = present(F.col(quoted(feature)))
        mean, sd = self.mean[feature], self.sd[feature]
        if not sd:
            return F.when(value.isNotNull(), F.lit(0.0))
        return (value - F.lit(mean)) / F.lit(sd)


def complete(features: Sequence[str]) -> Column:
    """True where every feature is a number."""
    result = F.lit(True)
    for f in features:
        result = result & present(F.col(quoted(f))).isNotNull()
    return result


def fit_scaling(df: DataFrame, features: Sequence[str]) -> Scaling:
    """Fit the scaling in one pass, which also counts rows and estimates distinct points."""
    usable = complete(features)
    points = F.struct(*[present(F.col(quoted(f))).alias(f) for f in features])
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(usable).alias("complete"),
        F.approx_count_distinct(F.when(usable, points), 0.1).alias("distinct"),
        *[
            how(F.when(usable, present(F.col(quoted(f))))).alias(f"{name}_{i}")
            for i, f in enumerate(features)
            for name, how in [("mean", F.avg), ("sd", F.stddev_samp)]
        ],
    ).first()
    return Scaling(
        {f: row[f"mean_{i}"] for i, f in enumerate(features)},
        {f: row[f"sd_{i}"] for i, f in enumerate(features)},
        row["rows"],
        row["complete"],
        row["distinct"],
    )


def standardise(df: DataFrame, features: Sequence[str], scaling: Scaling | None = None) -> DataFrame:
    """Replace each feature by its standardised value."""
    scaling = scaling or fit_scaling(df, features)
    return df.withColumns({f: scaling.scaled(f) for f in features})


def scaled_points(df: DataFrame, features: Sequence[str], scaling: Scaling) -> DataFrame:
    """The standardised features of the complete rows, equal points merged, with their weight.

    Merging leaves the clustering problem unchanged, shrinks every later pass, and partial counts
    absorb a point that holds a large share of the rows. A seeded start depends on how points are
    dealt to tasks, so that follows from the points alone: their partitions are a function of their
    (estimated) number and their values, sorted within, whatever the input's files, the size of the
    table or the cores of the cluster.
    """
    merged = (
        df.where(complete(features))
        .groupBy(*[present(F.col(quoted(f))).alias(f) for f in features])
        .agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))
    )
    names = [quoted(f) for f in features]
    parts = max(1, -(-scaling.distinct_rows // POINTS_PER_PARTITION))
    ordered = merged.repartition(parts, *names).sortWithinPartitions(*names)
    return ordered.select(*[scaling.scaled(f).alias(f) for f in features], WEIGHT)


def as_vectors(points: DataFrame, features: Sequence[str]) -> DataFrame:
    """Points with their features assembled into one vector."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return assembler.transform(points).select("features", WEIGHT)


def as_points(vectors: DataFrame, features: Sequence[str]) -> DataFrame:
    """The inverse of ``as_vectors``."""
    opened = vectors.select(vector_to_array("features").alias("_x"), WEIGHT)
    return opened.select(*[F.col("_x")[i].alias(f) for i, f in enumerate(features)], WEIGHT)


def nearest_centre(values: Sequence[Column], centres: Sequence[Sequence[float]]) -> Column:
    """Index of the centre at the least squared distance, the first of equals; null if incomplete."""
    candidates = []
    for i, centre in enumerate(centres):
        distance = F.lit(0.0)
        for value, x in zip(values, centre):
            distance = distance + (value - F.lit(float(x))) * (value - F.lit(float(x)))
        candidates.append(F.struct(distance.alias("d"), F.lit(i).alias("i")))
    least = F.array_min(F.array(*candidates)).getField("i")
    known = F.lit(True)
    for value in values:
        known = known & value.isNotNull()
    return F.when(known, least)


def assign_clusters(
    df: DataFrame,
    features: Sequence[str],
    centres: Sequence[Sequence[float]],
    scaling: Scaling | None = None,
    name: str = S.CLUSTER,
) -> DataFrame:
    """Add the nearest centre to every row; a row that lacks a feature has no cluster."""
    values = {
        f"_z{i}": scaling.scaled(f) if scaling else present(F.col(quoted(f)))
        for i, f in enumerate(features)
    }
    nearest = nearest_centre([F.col(z) for z in values], centres)
    return df.withColumns(values).withColumn(name, nearest).drop(*values)


def silhouette(
    df: DataFrame, features: Sequence[str], cluster: str, weight: str | None = None
) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, as one row.

    The mean squared distance from a row to a cluster follows from the cluster's size, vector sum
    and sum of squared norms, so two passes suffice: one for those sums, one to score the rows. The
    sums, a row per cluster, become one array that the second pass reads as a scalar subquery.
    """
    w = F.col(quoted(weight)).cast("double") if weight else F.lit(1.0)
    xs = [F.col(f"x{i}") for i in range(len(features))]
    rows = df.select(
        F.col(quoted(cluster)).alias("c"),
        w.alias("w"),
        *[present(F.col(quoted(f))).alias(f"x{i}") for i, f in enumerate(features)],
    ).where(F.col("c").isNotNull())
    rows = rows.withColumn("norm", sum((x * x for x in xs[1:]), xs[0] * xs[0]))
    sums = rows.groupBy("c").agg(
        F.sum("w").alias("n"),
        F.sum(F.col("w") * F.col("norm")).alias("q"),
        *[F.sum(F.col("w") * x).alias(f"s{i}") for i, x in enumerate(xs)],
    )
    # Mean squared distance from a row to a cluster: norm + offset + slopes . x
    profile = F.struct(
        "c",
        F.col("n").cast("double").alias("n"),
        (F.col("q") / F.col("n")).alias("offset"),
        *[(F.col(f"s{i}") * -2 / F.col("n")).alias(f"m{i}") for i in range(len(xs))],
    )
    profiles = sums.agg(F.sort_array(F.collect_list(profile)).alias("p")).scalar()

    def step(seen: Column, p: Column) -> Column:
        d = sum((x * p[f"m{i}"] for i, x in enumerate(xs)), F.col("norm") + p["offset"])
        mine = p["c"] == F.col("c")
        return F.struct(
            F.when(mine, p["n"]).otherwise(seen["size"]).alias("size"),
            F.when(mine, d).otherwise(seen["own"]).alias("own"),
            F.when(mine, seen["other"]).otherwise(F.least(seen["other"], d)).alias("other"),
        )

    unknown = F.lit(None).cast("double")
    start = F.struct(*[unknown.alias(name) for name in ("size", "own", "other")])
    compared = rows.withColumn("_profiles", profiles)
    found = F.aggregate(F.col("_profiles"), start, step)
    seen = compared.withColumn("_seen", found).select("w", "_seen.*")
    a, b, size = F.col("own") * F.col("size") / (F.col("size") - 1), F.col("other"), F.col("size")
    score = (
        F.when((size <= 1) | b.isNull(), 0.0)
        .when(a < b, 1 - a / b)
        .when(a > b, b / a - 1)
        .otherwise(0.0)
    )
    scored = seen.select("w", score.alias("score"))
    total = F.sum(F.col("w") * F.col("score")) / F.sum("w")
    return scored.agg(total.alias("silhouette_score"))


def sweep(
    vectors: DataFrame,
    features: Sequence[str],
    counts: Iterable[int] = S.CLUSTER_COUNTS,
    seed: int = S.SEED,
    max_iter: int = 20,
    parallelism: int = 6,
) -> dict[int, tuple[list[list[float]], float]]:
    """Fit and score one k-means model per k over persisted vectors: centres and silhouette.

    Centres come in coordinate order. The models are independent, so a few are fitted and scored
    side by side and share the executors.
    """
    points = as_points(vectors, features)

    def fit(k: int) -> tuple[list[list[float]], float]:
        model = KMeans(
            k=k,
            seed=seed,
            maxIter=max_iter,
            featuresCol="features",
            predictionCol=S.CLUSTER,
            weightCol=WEIGHT,
        ).fit(vectors)
        centres = sorted([float(x) for x in centre] for centre in model.clusterCenters())
        assigned = assign_clusters(points, features, centres)
        return centres, silhouette(assigned, features, S.CLUSTER, WEIGHT).first()[0]

    counts = list(counts)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        target = inheritable_thread_target(vectors.sparkSession)(fit)
        return dict(zip(counts, pool.map(target, counts)))
