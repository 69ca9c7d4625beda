"""Byte-balanced shards for groups of equal texts, by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from mishap.llm.common import buckets, hash_bucket, quoted, staged

GROUPS_PER_BUCKET = 8_192
ROWS_PER_SLOT_RANGE = 65_536
SLOT_RANGES = 64


def difference(loads: Sequence[Sequence[int]]) -> list[list[int]]:
    """Karmarkar-Karp: for every partial partition, the shard that each of its bins joins.

    The two partial partitions of largest spread are combined again and again, the heaviest bin of
    one with the lightest of the other, until one is left. An item is a partial partition with one
    bin in use.
    """
    if not loads:
        return []
    k = len(loads[0])
    orders = [sorted(range(k), key=load.__getitem__) for load in loads]
    sums = [[load[i] for i in order] for load, order in zip(loads, orders)]
    heap = [(s[0] - s[-1], n) for n, s in enumerate(sums)]
    heapq.heapify(heap)
    children: dict[int, tuple[int, int, list[int]]] = {}
    last = k - 1
    while len(heap) > 1:
        first = heapq.heappop(heap)[1]
        second = heapq.heappop(heap)[1]
        a, b = sums[first], sums[second]
        joined = [x + y for x, y in zip(a, reversed(b))]
        order = sorted(range(k), key=joined.__getitem__)
        sums[first] = sums[second] = None
        children[len(sums)] = first, second, order
        heapq.heappush(heap, (joined[order[0]] - joined[order[-1]], len(sums)))
        sums.append([joined[i] for i in order])
    shards: list[list[int]] = [[]] * len(sums)
    shards[heap[0][1]] = list(range(k))
    for parent in reversed(range(len(loads), len(sums))):
        first, second, order = children[parent]
        a, b = [0] * k, [0] * k
        for place, shard in zip(order, shards[parent]):
            a[place] = shard
            b[last - place] = shard
        shards[first], shards[second], shards[parent] = a, b, []
    result = []
    for order, of_place in zip(orders, shards):
        bins = [0] * k
        for place, i in enumerate(order):
            bins[i] = of_place[place]
        result.append(bins)
    return result


def _bins(table: pa.Table, shards: int) -> pa.Table:
    """Distribute the groups of one bucket over bins."""
    table = table.sort_by([("total", "descending"), ("k1", "ascending"), ("k2", "ascending")])
    loads = [[0] * (shards - 1) + [total] for total in table.column("total").to_pylist()]
    bins = [chosen[-1] for chosen in difference(loads)]
    return table.append_column("bin", pa.array(bins, pa.int32()))


def _combined(table: pa.Table, shards: int) -> pa.Table:
    """Distribute the bins of the partial partitions of one group over the bins of their parent.

    Adds ``to``, the parent's bin of each bin, and ``moved``, the loads in the parent's order.
    """
    table = table.sort_by("bucket")
    loads = table.column("loads").to_pylist()
    chosen = difference(loads)
    moved = [[load[bins.index(i)] for i in range(shards)] for load, bins in zip(loads, chosen)]
    return pa.table(
        {
            "bucket": table.column("bucket"),
            "parent": table.column("parent"),
            "to": pa.array(chosen, pa.list_(pa.int32())),
            "moved": pa.array(moved, pa.list_(pa.int64())),
        }
    )


def assign(placed: DataFrame, many: int, shards: int, per_bucket: int) -> DataFrame:
    """(k1, k2, shard) from groups placed in bins (k1, k2, total, bucket, bin) of ``many`` buckets.

    In each round at most ``per_bucket`` partial partitions (on average) are differenced in one task
    into one, until one is left. A round leaves a table of one row per partial partition, which the
    groups look their next bin up in; nothing passes through the driver.
    """

    def totals(of: DataFrame, key: str, value: Callable[[int], Column]) -> DataFrame:
        return of.groupBy(F.col(key).alias("bucket")).agg(F.array(*map(value, range(shards))).alias("loads"))

    loads = totals(placed, "bucket", lambda i: F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("total"))), F.lit(0)))
    assigned = placed.select("k1", "k2", "bucket", "bin")
    while many > 1:
        many = buckets(many, per_bucket)
        dealt = loads.withColumn("parent", hash_bucket(many, "bucket"))
        step = staged(
            dealt.groupBy("parent").applyInArrow(
                lambda table: _combined(table, shards),
                "bucket int, parent int, to array<int>, moved array<long>",
            )
        )
        assigned = assigned.join(step.select("bucket", "parent", "to"), "bucket").select(
            "k1", "k2", F.col("parent").alias("bucket"), F.get("to", F.col("bin")).alias("bin")
        )
        loads = totals(step, "parent", lambda i: F.sum(F.get("moved", F.lit(i))))
    return assigned.select("k1", "k2", F.col("bin").alias("shard"))


def shard(
    docs: DataFrame, shards: int = 8, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: id, size (UTF-8 bytes of the text + 1), text_crc32, law 'bytes', shard, slot, grown_shard.

    Rows of equal text form a group that stays together; a null text is an empty one. Groups are
    added up first, so copies cost one row, and dealt to buckets by their hash. Each bucket of about
    ``GROUPS_PER_BUCKET`` groups is differenced in its own task into one partial partition, and those
    again in further rounds. The text itself is never shuffled. ``slot`` numbers a shard's rows from
    0 without gaps: rows fall into ranges by the hash of their place in the table, range sizes add up
    to offsets, and rows are numbered within their range, so repeated ids and rows spread as well. A group larger than a shard's share
    makes its shard larger than the others. ``grown_shard`` is null, as the law is 'bytes'.
    """
    content = F.coalesce(F.col(quoted(text)), F.lit(""))
    rows = staged(
        docs.select(
            F.col(quoted(row_id)).alias("id"),
            (F.octet_length(content) + 1).cast("long").alias("size"),
            F.crc32(content.cast("binary")).alias("crc"),
            F.xxhash64(content).alias("k1"),
            F.xxhash64(content, F.lit("second")).alias("k2"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    groups = rows.groupBy("k1", "k2").agg(F.sum("size").alias("total"))
    many = buckets(rows.select("k1", "k2").distinct().count(), GROUPS_PER_BUCKET)
    bucketed = groups.withColumn("bucket", hash_bucket(many, "k2", "k1"))
    placed = staged(
        bucketed.groupBy("bucket").applyInArrow(
            lambda table: _bins(table, shards), "k1 long, k2 long, total long, bucket int, bin int"
        )
    )
    assigned = assign(placed, many, shards, GROUPS_PER_BUCKET)
    ranges = max(SLOT_RANGES, buckets(rows.count(), ROWS_PER_SLOT_RANGE))
    dealt = rows.join(assigned, ["k1", "k2"]).withColumn("range", hash_bucket(ranges, "row"))
    dealt = staged(dealt.select("id", "size", "crc", "shard", "range", "row"))
    counts = dealt.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("range")) - F.col("n")
    offsets = counts.select("shard", "range", before.alias("before"))
    number = F.row_number().over(W.partitionBy("shard", "range").orderBy("row")) - 1
    numbered = dealt.withColumn("number", number).join(offsets, ["shard", "range"])
    return numbered.select(
        F.col("id").alias(row_id),
        "size",
        F.col("crc").cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("number") + F.col("before")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
