"""Class-weighted random forest over mixed features, and what is read off the fitted model."""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.operators.encoding import category_counts, class_weights, dictionary, modes
from mishap.operators.hygiene import quoted
from mishap.operators.quantiles import exact_medians
from mishap.operators.sampling import mark_first
from mishap.operators.sketches import median, merge, sketches
from mishap.sources.tables import stage

LABEL = "_label"
WEIGHT = "_weight"
FEATURES = "_features"
# Drawn rows are dealt to this many tasks: each sends statistics of all open nodes at every level.
TRAINING_TASKS = 24


@dataclass(frozen=True)
class FeatureSet:
    numeric: Sequence[str] = tuple(S.RISK_NUMERIC)
    categorical: Sequence[str] = tuple(S.RISK_CATEGORICAL)
    binary: Sequence[str] = tuple(S.RISK_BINARY)

    @property
    def all(self) -> list[str]:
        return [*self.numeric, *self.categorical, *self.binary]


@dataclass(frozen=True)
class ForestParams:
    """What shapes the fit.

    The trees are fitted on all training rows, whatever their number. Only a caller who names
    ``max_training_rows`` bounds them: beyond it, each class gives its first rows in hashed order, in
    shares as equal as the class sizes allow, and their weights stand for the whole class. Medians,
    modes, categories and class sizes always come from all training rows. ``max_listed`` bounds the
    categories of a column that are held as a list; a longer column is encoded by a join with its
    written dictionary.
    """

    trees: int = 200
    max_depth: int = 10
    max_bins: int = 64
    seed: int = S.SEED
    relative_error: float = 0.001
    exact_medians: bool = False
    max_memory_mb: int = 1024
    max_training_rows: int | None = None
    max_listed: int = 1_000


@dataclass(frozen=True)
class RiskModel:
    """A fitted pipeline, the names of its vector's entries and its classes in index order.

    ``features`` is a table (position, feature); ``fitted_rows`` of the ``training_rows`` went into
    the trees.
    """

    pipeline: PipelineModel
    features: DataFrame
    classes: list[str]
    weights: dict[str, float]
    training_rows: int
    fitted_rows: int


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def training_profile(
    train: DataFrame, features: FeatureSet, params: ForestParams, label: str | None = None
) -> DataFrame:
    """What preprocessing learns, in one job: (column, value, n, sketch).

    Rows with ``n`` count the values of the categorical, binary and label columns. Rows with a
    ``sketch`` describe a numeric column's values within the class ``value``. Both parts read columns
    of their own, so together they read the table once.
    """
    columns = [F.col(quoted(c)) for c in [*features.categorical, *([label] if label else [])]]
    columns += [F.col(quoted(c)).cast("int").alias(c) for c in features.binary]
    empty = F.lit(None).cast("binary").alias("sketch")
    parts = []
    if columns:
        named = train.select(*columns)
        parts.append(category_counts(named, named.columns).select("*", empty))
    if features.numeric and not params.exact_medians:
        classed = train.withColumn("_class", F.col(quoted(label)) if label else F.lit(None).cast("string"))
        found = sketches(classed, features.numeric, params.relative_error, ["_class"])
        pairs = [
            F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch"))
            for i, c in enumerate(features.numeric)
        ]
        each = found.select(F.col("_class").alias("value"), F.inline(F.array(*pairs)))
        parts.append(each.select("column", "value", F.lit(None).cast("long").alias("n"), "sketch"))
    if not parts:
        return train.sparkSession.createDataFrame([], "column string, value string, n long, sketch binary")
    return stage(functools.reduce(DataFrame.unionByName, parts), "profile")


def training_medians(
    train: DataFrame, features: FeatureSet, params: ForestParams, profile: DataFrame
) -> dict[str, float | None]:
    """Median per numeric column over all classes, from the profile's sketches."""
    if not features.numeric:
        return {}
    if params.exact_medians:
        return exact_medians(train, features.numeric, midpoint=True)
    merged = profile.where("sketch is not null").groupBy("column").agg(merge(F.col("sketch")).alias("s"))
    found = {row["column"]: row["m"] for row in merged.select("column", median(F.col("s")).alias("m")).collect()}
    return {c: found.get(c) for c in features.numeric}


def _category_stages(column: str, size: int, values: list[str] | None, path: str) -> Transformer:
    """From ``categorical__c`` to ``index__c``: the value's place, or ``size`` for an unseen one."""
    if values is not None:
        return StringIndexerModel.from_labels(
            values, f"categorical__{column}", f"index__{column}", handleInvalid="keep"
        )
    key, index = quoted(f"categorical__{column}"), quoted(f"index__{column}")
    return SQLTransformer(
        statement=f"SELECT t.*, CAST(coalesce(d.place, {size}) AS DOUBLE) AS {index} FROM __THIS__ t "
        f"LEFT JOIN (SELECT value, place FROM parquet.`{path}` WHERE column = {_text(column)}) d "
        f"ON d.value = t.{key}"
    )


def preprocessor(
    train: DataFrame, features: FeatureSet, params: ForestParams, profile: DataFrame
) -> tuple[PipelineModel, DataFrame]:
    """Impute, one-hot encode and assemble, learned from the profile of the training rows.

    Returns the pipeline and its vector's entries as a table (position, feature). A category that
    training did not see encodes to zeros; a column without training values is left out of the
    vector. Only the lists of columns with few categories come to the driver.
    """
    spark = train.sparkSession
    counts = profile.where("n is not null")
    best = {row["column"]: row["value"] for row in modes(counts).collect()}
    middle = training_medians(train, features, params, profile)
    listed = dictionary(counts.where(F.col("column").isin(list(features.categorical))))
    path = listed.inputFiles()[0].rsplit("/", 1)[0] if not listed.isEmpty() else ""
    sizes = {r["column"]: r["size"] for r in listed.groupBy("column").agg(F.count("*").alias("size")).collect()}
    short = [c for c, n in sizes.items() if n <= params.max_listed]
    values: dict[str, list[str]] = {c: [] for c in short}
    for row in listed.where(F.col("column").isin(short)).orderBy("column", "place").collect():
        values[row["column"]].append(row["value"])

    numeric = [c for c in features.numeric if middle[c] is not None]
    categorical = [c for c in features.categorical if c in sizes]
    binary = [c for c in features.binary if c in best]

    filled = []
    for c in numeric:
        number = f"nullif(cast({quoted(c)} as double), double('NaN'))"
        filled.append(f"coalesce({number}, {float(middle[c])!r}D) AS {quoted('numerical__' + c)}")
    for c in categorical:
        value = f"cast({quoted(c)} as string)"
        filled.append(f"coalesce({value}, {_text(best[c])}) AS {quoted('categorical__' + c)}")
    for c in binary:
        value = f"cast(cast({quoted(c)} as int) as double)"
        filled.append(f"coalesce({value}, {best[c]}D) AS {quoted('binary__' + c)}")

    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")]
    if categorical:
        for c in categorical:
            stages.append(_category_stages(c, sizes[c], values.get(c), path))
        encoder = OneHotEncoder(
            inputCols=[f"index__{c}" for c in categorical],
            outputCols=[f"onehot__{c}" for c in categorical],
            dropLast=True,
        )
        # One row with the largest index of every column tells the encoder all it needs.
        widest = [F.lit(float(sizes[c])).alias(f"index__{c}") for c in categorical]
        stages.append(encoder.fit(spark.range(1).select(*widest)))
    stages.append(
        VectorAssembler(
            inputCols=[f"numerical__{c}" for c in numeric]
            + [f"onehot__{c}" for c in categorical]
            + [f"binary__{c}" for c in binary],
            outputCol=FEATURES,
        )
    )
    fixed = [(i, f"numerical__{c}") for i, c in enumerate(numeric)]
    starts, width = [], len(numeric)
    for c in categorical:
        starts.append((c, width))
        width += sizes[c]
    fixed += [(width + i, f"binary__{c}") for i, c in enumerate(binary)]
    start = spark.createDataFrame(starts, "column string, start long")
    encoded = listed.join(start, "column").select(
        (F.col("start") + F.col("place")).alias("position"),
        F.concat(F.lit("categorical__"), "column", F.lit("_"), "value").alias("feature"),
    )
    names = spark.createDataFrame(fixed, "position long, feature string").unionByName(encoded)
    return PipelineModel(stages), names


def class_quotas(sizes: dict[str, int], limit: int) -> dict[str, int]:
    """Rows to draw per class: equal shares of the limit, what a small class leaves goes to the others."""
    quotas, left, classes = {}, limit, sorted(sizes, key=lambda c: (sizes[c], c))
    for i, c in enumerate(classes):
        quotas[c] = min(sizes[c], left // (len(classes) - i))
        left -= quotas[c]
    return quotas


def draw(
    train: DataFrame, label: str, row_id: str | None, sizes: dict[str, int], limit: int, seed: int
) -> tuple[DataFrame, dict[str, int]]:
    """At most ``limit`` labelled rows, the first of each class in hashed order, and their number per class.

    Without an id, rows are ordered by the hash of all their columns.
    """
    if sum(sizes.values()) <= limit:
        return train, dict(sizes)
    quotas = class_quotas(sizes, limit)
    spark = train.sparkSession
    table = spark.createDataFrame(list(quotas.items()), f"{quoted(label)} string, quota long")
    key = F.col(quoted(row_id)) if row_id else F.xxhash64(*map(quoted, train.columns))
    marked = mark_first(train.withColumn("_draw", key), [label], "_draw", lambda s: s.join(table, label), seed)
    return marked.where("_picked").drop("_picked", "_draw"), quotas


def fit_forest(
    train: DataFrame,
    label: str = S.RISK,
    features: FeatureSet = FeatureSet(),
    params: ForestParams = ForestParams(),
    row_id: str | None = None,
) -> RiskModel:
    """Fit the preprocessing and a forest with balanced class weights on the labelled rows."""
    of_class = F.col(quoted(label)).cast("string")
    ids = [row_id] if row_id and row_id not in [*features.all, label] else []
    train = train.select(of_class.alias(label), *[quoted(c) for c in [*features.all, *ids]]).where(
        of_class.isNotNull()
    )
    profile = training_profile(train, features, params, label)
    found = class_weights(profile.where((F.col("column") == label) & F.col("n").isNotNull())).collect()
    sizes = {row["value"]: row["rows"] for row in found}
    weights = {row["value"]: row["weight"] for row in found}
    classes = sorted(weights)
    prepare, names = preprocessor(train, features, params, profile.where(F.col("column") != label))
    drawn, taken = train, dict(sizes)
    if params.max_training_rows is not None:
        drawn, taken = draw(train, label, row_id, sizes, params.max_training_rows, params.seed)
    if sum(taken.values()) < sum(sizes.values()):
        # They lie scattered over all tasks of the table; what the trees read must not follow its size.
        columns = [*map(quoted, drawn.columns)]
        drawn = drawn.repartition(TRAINING_TASKS, *columns).sortWithinPartitions(*columns)
    # A drawn row stands for as many rows as its class has for each that was drawn.
    shares = {c: weights[c] * sizes[c] / taken[c] for c in classes if taken[c]}

    def lookup(values: dict) -> Column:
        pairs = [F.lit(x) for item in values.items() for x in item]
        return F.element_at(F.create_map(*pairs), F.col(quoted(label)))

    vectors = (
        prepare.transform(drawn)
        .select(
            F.col(FEATURES),
            lookup({c: float(i) for i, c in enumerate(classes)}).alias(LABEL),
            lookup(shares).alias(WEIGHT),
        )
        .persist()
    )
    try:
        forest = RandomForestClassifier(
            featuresCol=FEATURES,
            labelCol=LABEL,
            weightCol=WEIGHT,
            numTrees=params.trees,
            maxDepth=params.max_depth,
            maxBins=params.max_bins,
            maxMemoryInMB=params.max_memory_mb,
            featureSubsetStrategy="sqrt",
            seed=params.seed,
        ).fit(vectors)
    finally:
        vectors.unpersist()
    to_class = IndexToString(inputCol="prediction", outputCol=S.PREDICTED_RISK, labels=classes)
    pipeline = PipelineModel([*prepare.stages, forest, to_class])
    return RiskModel(pipeline, names, classes, weights, sum(sizes.values()), sum(taken.values()))


def predict(model: RiskModel, df: DataFrame, context: Sequence[str]) -> DataFrame:
    """The context columns with the predicted class and one probability per class, by class name."""
    scored = model.pipeline.transform(df)
    chances = vector_to_array("probability")
    return scored.select(
        *[quoted(c) for c in context],
        S.PREDICTED_RISK,
        *[chances[i].alias(f"Probability_{c}") for i, c in enumerate(model.classes)],
    )


def feature_importance(model: RiskModel, spark: SparkSession) -> DataFrame:
    """Gini importance of every vector entry, highest first; the number of rows is the vector's width.

    Scores other than zero are as many as the trees have splits at most.
    """
    forest = next(s for s in model.pipeline.stages if hasattr(s, "featureImportances"))
    scores = forest.featureImportances
    pairs = list(zip(map(int, scores.indices), map(float, scores.values)))
    used = spark.createDataFrame(pairs, "position long, score double")
    joined = model.features.join(used, "position", "left")
    importance = joined.select("feature", F.coalesce("score", F.lit(0.0)).alias("importance"))
    return importance.orderBy(F.desc("importance"), "feature")


_DICTIONARY = re.compile(r"parquet\.`[^`]*`")


def _dictionary_stages(pipeline: PipelineModel) -> list[SQLTransformer]:
    joins = [s for s in pipeline.stages if isinstance(s, SQLTransformer)]
    return [s for s in joins if _DICTIONARY.search(s.getStatement())]


def save_model(model: RiskModel, path: str) -> None:
    """Write the model as one folder: pipeline, dictionaries of long columns, and a manifest as tables."""
    spark = model.features.sparkSession
    joins = _dictionary_stages(model.pipeline)
    if joins:
        source = _DICTIONARY.search(joins[0].getStatement())[0][len("parquet.`") : -1]
        spark.read.parquet(source).write.mode("overwrite").parquet(f"{path}/dictionary")
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    model.features.write.mode("overwrite").parquet(f"{path}/features")
    classes = [(i, c, model.weights[c]) for i, c in enumerate(model.classes)]
    table = spark.createDataFrame(classes, "position int, class string, weight double")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/classes")
    rows = spark.createDataFrame([(model.training_rows, model.fitted_rows)], "training long, fitted long")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/rows")


def load_model(spark: SparkSession, path: str) -> RiskModel:
    """A saved model, wherever its folder now lies."""
    pipeline = PipelineModel.load(f"{path}/pipeline")
    for join in _dictionary_stages(pipeline):
        moved = f"parquet.`{path.rstrip('/')}/dictionary`"
        join.setStatement(_DICTIONARY.sub(lambda _: moved, join.getStatement()))
    classes = spark.read.parquet(f"{path}/classes").orderBy("position").collect()
    rows = spark.read.parquet(f"{path}/rows").first()
    return RiskModel(
        pipeline,
        spark.read.parquet(f"{path}/features"),
        [row["class"] for row in classes],
        {row["class"]: row["weight"] for row in classes},
        rows["training"],
        rows["fitted"],
    )
