"""Classification metrics from the counts of (true class, predicted class)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.operators.hygiene import quoted


def confusion_matrix(
    df: DataFrame,
    truth: str = S.RISK,
    predicted: str = S.PREDICTED_RISK,
    classes: Sequence = tuple(S.RISK_CLASSES),
) -> DataFrame:
    """Every cell (truth, predicted, n) in the listed class order, empty cells as 0.

    The data is touched once, by a count per pair of classes; the cells are laid out from the
    class list, so the result has exactly ``len(classes)`` squared rows. Pairs are told apart after
    the count and met by a null-safe join: Spark would move a condition on the class below the
    projection that predicts, and run the model again for every mention of it.
    """
    classes = list(classes)
    t, p = F.col(quoted(truth)), F.col(quoted(predicted))
    listed = F.bool_or(t.isin(classes) & p.isin(classes))
    counts = (
        df.groupBy(t.alias("truth"), p.alias("predicted"))
        .agg(F.count(F.lit(1)).alias("n"), listed.alias("listed"))
        .where("listed")
        .select(F.col("truth").alias("_truth"), F.col("predicted").alias("_predicted"), "n")
    )
    cells = [
        (i, j, a, b) for i, a in enumerate(classes) for j, b in enumerate(classes)
    ]
    layout = df.sparkSession.createDataFrame(
        cells, ["true_order", "predicted_order", "truth", "predicted"]
    ).withColumns({c: F.col(c).cast("int") for c in ("true_order", "predicted_order")})
    same = F.col("truth").eqNullSafe(F.col("_truth")) & F.col("predicted").eqNullSafe(F.col("_predicted"))
    return (
        layout.join(F.broadcast(counts), same, "left")
        .select(
            "true_order",
            "predicted_order",
            "truth",
            "predicted",
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        )
        .orderBy("true_order", "predicted_order")
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def class_scores(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each class; a zero denominator scores 0."""
    as_truth = F.col("side") == "truth"
    as_predicted = F.col("side") == "predicted"
    hit = F.col("true_order") == F.col("predicted_order")
    sides = matrix.select(
        F.when(hit, F.col("n")).otherwise(0).alias("hits"),
        "n",
        F.explode(
            F.array(
                F.struct(
                    F.lit("truth").alias("side"),
                    F.col("truth").alias("class"),
                    F.col("true_order").alias("ord"),
                ),
                F.struct(
                    F.lit("predicted").alias("side"),
                    F.col("predicted").alias("class"),
                    F.col("predicted_order").alias("ord"),
                ),
            )
        ).alias("s"),
    ).select("n", "hits", "s.*")
    sums = sides.groupBy("class", "ord").agg(
        F.sum(F.when(as_truth, F.col("hits"))).alias("hits"),
        F.sum(F.when(as_truth, F.col("n"))).alias("support"),
        F.sum(F.when(as_predicted, F.col("n"))).alias("claimed"),
    )
    scored = sums.withColumns(
        {
            "precision": _ratio(F.col("hits"), F.col("claimed")),
            "recall": _ratio(F.col("hits"), F.col("support")),
        }
    )
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.withColumn("f1", f1).select(
        "ord", "class", "hits", "support", "precision", "recall", "f1"
    )


def classification_report(matrix: DataFrame) -> DataFrame:
    """Long form (metric, class, value): the per-class scores, accuracy, macro and weighted means.

    The matrix is used once: one aggregation gives the class rows and all that is summed over them.
    """
    measures = ["precision", "recall", "f1"]
    support = F.sum("support").cast("double").alias("support")
    own = [*measures, F.col("support").cast("double").alias("support")]
    means = [F.avg(m).alias(m) for m in measures]
    weighted = [_ratio(F.sum(F.col(m) * F.col("support")), support).alias(m) for m in measures]
    summary = class_scores(matrix).agg(
        F.collect_list(F.struct("class", *own)).alias("classes"),
        F.struct(F.lit("macro avg").alias("class"), *means, support).alias("macro"),
        F.struct(F.lit("weighted avg").alias("class"), *weighted, support).alias("weighted"),
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
    )

    def entries(row: Column) -> Column:
        names = [*measures, "support"]
        return F.array(*[_entry(F.lit(m), row["class"], row[m]) for m in names])

    rows = F.concat("classes", F.array("macro"), F.array("weighted"))
    accuracy = F.array(_entry(F.lit("accuracy"), F.lit("all"), F.col("accuracy")))
    return summary.select(F.inline(F.concat(F.flatten(F.transform(rows, entries)), accuracy)))


def _entry(metric: Column, name: Column, value: Column) -> Column:
    return F.struct(metric.alias("metric"), name.alias("class"), value.alias("value"))


def balanced_accuracy(matrix: DataFrame) -> DataFrame:
    """Mean recall over the classes that occur."""
    return class_scores(matrix).where("support > 0").agg(
        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("balanced_accuracy")
    )
