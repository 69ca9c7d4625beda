"""Numbers in sorted order without sorting in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mishap.operators.hygiene import quoted
from mishap.sources.tables import stage

PLACE_BITS = 33  # monotonically_increasing_id: the task above, the place in the task below


def numbered(df: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """Add ``place``: the row's number, from 0, in the order of ``keys`` (nulls first).

    Rows are dealt by ranges of the keys and sorted and counted inside each task; the tasks' counts,
    one row per task, are summed up to offsets. Rows with equal keys lie in one range.
    """
    order = [F.col(quoted(k)).asc_nulls_first() for k in keys]
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranges = stage(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    task = F.shiftright("_at", PLACE_BITS)
    sizes = ranges.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        ranges.withColumn("_task", task)
        .join(stage(offsets, "offsets"), "_task")
        .withColumn(place, F.col("_offset") + within)
        .select(*[quoted(c) for c in df.columns], place)
    )
