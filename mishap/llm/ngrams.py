"""Exact self-join of documents by Jaccard similarity of word n-grams, as connected components.

The overlap counts are a product of the sparse document by n-gram incidence matrix with its
transpose. It is computed in blocks, and the size-derived bound (two sets of sizes a and b that
reach the threshold differ in at most (a + b)(1 - t)/(1 + t) n-grams) both selects the blocks and
discards pairs:

* Sizes fall into classes whose ends differ by the threshold, so linked sets share a size class tag.
  For a tag the bound allows at most d differing n-grams, so of d + 1 + k hash ranges of n-grams at
  least k + 1 hold the same n-grams in both sets. A document yields one signature per tag and range
  that isn't empty: a set with at most k empty ranges agrees with every linked one in a filled range.
  The few sets with more are dealt anew by another hash, so that emptiness, which unrelated sets
  have in common, is no signature until the last of several rounds.
  Documents connected by equal signatures form a candidate block, a superset of the links.
* Documents that share a passage can meet by a range that holds nothing else. So the members of
  larger blocks are connected anew, by the first n-grams of each: under any order of the block's
  n-grams, the first s - ceil(t s) + 1 of a set of size s include one of those of any linked set.
  The order is by the number of members that have an n-gram, so those of the passage come last, and
  a set that has enough n-grams of its own before them meets nobody.
* Blocks are dealt in tiles of bounded size; every pair of tiles is one product, column block by
  column block. Columns that one row alone has cannot add overlap and are left out.
* A pair is linked if 100 * overlap >= percent * union, in integers. Tiles return one tie per
  document, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from mishap.llm.common import field, map_batches, quoted, staged, unstaged
from mishap.llm.graphs import components, local_roots
from mishap.llm.rolling import DIGESTS, mix, runs

TILE_GRAMS = 1 << 19
TILE_ROWS = 512
COLUMNS_AT_ONCE = 2_048
# Blocks of more members are connected anew. All of them tell how many have an n-gram, where once one
# of so many did; tests still set the number, which nothing reads.
CLOSE_ROWS = 64
SAMPLED = 1
# Rounds of hash ranges, and the share of sets that may go on to the next one.
ROUNDS = 12
NEXT_ROUND = 0.2
SET = "set_a long, set_b long"


def gram_set(text: bytes | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of lower-cased words; a shorter text is one n-gram."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digests = DIGESTS.array(words)
    if len(words) < n:
        short = xxhash.xxh3_64_intdigest(digests.tobytes(), seed=len(words))
        return np.array([short], np.uint64)
    return np.unique(runs(digests, n))


def set_key(grams: np.ndarray) -> tuple[int, int]:
    """128-bit key of a set."""
    digest = np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), np.int64)
    return int(digest[0]), int(digest[1])


def size_class(size: int, percent: int) -> tuple[int, int]:
    """Number of the class of a set size, and the largest size of the class."""
    number, low = 0, 1
    while True:
        high = low * 100 // percent
        if size <= high:
            return number, high
        number, low = number + 1, high + 1


def hash_ranges(high: int, percent: int) -> tuple[int, int]:
    """Number of hash ranges for a size class tag, by its largest size, and how many may be empty.

    The sets of a tag belong to its class or the one below; the smallest have the most empty ranges.
    """
    differing = 2 * high * (100 - percent) // (100 + percent)
    if not differing:
        return 1, 0
    size, spare = max(1, high * percent * percent // 10_000), 0
    while True:
        ranges = differing + 1 + spare
        empty = ranges * math.exp(-size / ranges)
        within = sum(math.exp(i * math.log(empty) - empty - math.lgamma(i + 1)) for i in range(spare + 1))
        if 1 - within < NEXT_ROUND or spare > size:
            return ranges, spare
        spare += 1


def signatures(grams: np.ndarray, percent: int, classes: dict) -> np.ndarray:
    """Hashes of n-gram ranges for the set's own class and for the next: linked sets share one."""
    size = len(grams)
    number, high = size_class(size, percent)
    if number not in classes:
        after = (high + 1) * 100 // percent
        classes[number] = (number, *hash_ranges(high, percent)), (number + 1, *hash_ranges(after, percent))
    found = []
    scrambled = mix(grams)
    for tag, ranges, spare in classes[number]:
        if ranges == 1:
            continue
        for turn in range(ROUNDS):
            dealt = grams if turn == 0 else mix(grams + np.uint64(turn))
            place = ((dealt >> np.uint64(20)) % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            counts = np.bincount(place, minlength=ranges)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(scrambled[order])])
            ends = np.concatenate([[0], np.cumsum(counts)])
            held = sums[ends[1:]] - sums[ends[:-1]]
            salt = np.arange(ranges, dtype=np.uint64) + np.uint64((tag << 36) + (turn << 32))
            signed = mix(held ^ mix(salt + np.uint64(1)))
            filled = counts > 0
            last = ranges - int(filled.sum()) <= spare
            found.append(signed[filled] if last or turn + 1 < ROUNDS else signed)
            if last:
                break
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[dict]:
    for batch in batches:
        sets = [gram_set(text, n) for text in batch.column("text").to_pylist()]
        keys = np.array([set_key(grams) for grams in sets], np.int64).reshape(-1, 2)
        yield {
            "doc_id": batch.column("doc_id"),
            "n": [len(grams) for grams in sets],
            "set_a": keys[:, 0],
            "set_b": keys[:, 1],
        }


def _signatures(batches: Iterator[pa.RecordBatch], n: int, percent: int) -> Iterator[dict]:
    classes: dict = {}
    for batch in batches:
        seen, signed, nodes = set(), [], []
        for text in batch.column("text").to_pylist():
            grams = gram_set(text, n)
            node, _ = key = set_key(grams)
            # Copies in the same batch have the same signatures.
            if len(grams) and key not in seen:
                seen.add(key)
                signed.append(signatures(grams, percent, classes))
                nodes.append(np.full(len(signed[-1]), node, np.int64))
        signed = np.concatenate(signed) if signed else np.zeros(0, np.uint64)
        nodes = np.concatenate(nodes) if nodes else np.zeros(0, np.int64)
        for start in range(0, len(nodes), 1 << 20):
            yield {
                "signature": signed[start : start + (1 << 20)].view(np.int64),
                "node": nodes[start : start + (1 << 20)],
            }


def _members(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[dict]:
    """The sets of block members; a row whose text isn't the member's set is dropped."""
    for batch in batches:
        sets = [gram_set(text, n) for text in batch.column("text").to_pylist()]
        keys = zip(batch.column("node").to_pylist(), batch.column("set_b").to_pylist())
        # Rows that repeat an id bring a member's set again: one of a batch is enough.
        found = {key: i for i, key in enumerate(keys) if set_key(sets[i]) == key}
        rows = sorted(found.values())
        taken = batch.take(pa.array(rows, pa.int64()))
        ends = np.cumsum([0, *(len(sets[i]) for i in rows)])
        values = np.concatenate([sets[i] for i in rows] or [np.zeros(0, np.uint64)])
        grams = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))
        names = [name for name in batch.schema.names if name not in ("text", "set_b")]
        yield {name: taken.column(name) for name in names} | {"grams": grams}


def linked_pairs(
    sets: list[np.ndarray], first: int, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row before ``first``, row from ``first``) that are linked; all pairs if first is 0."""
    sizes = np.array([len(s) for s in sets], np.int64)
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df[column] > 1
    row, column = row[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    left = first or len(sets)
    rights = slice(first, None)
    overlap = np.zeros((left, len(sets) - first), np.float32)
    last = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, last, COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, [low, low + COLUMNS_AT_ONCE])
        block = np.zeros((len(sets), min(COLUMNS_AT_ONCE, last - low)), np.float32)
        block[row[a:b], column[a:b] - low] = 1
        overlap += block[:left] @ block[rights].T
    # Counts are exact in single precision up to 2^24 shared n-grams.
    counts = overlap.astype(np.int64)
    union = sizes[:left, None] + sizes[rights] - counts
    a, b = np.nonzero(100 * counts >= percent * union)
    if not first:
        a, b = a[a < b], b[a < b]
    return a, b + first


def _tile(table: pa.Table, percent: int) -> pa.Table:
    """Ties (node, root) of the links within one pair of tiles."""
    side = table.column("side").to_numpy()
    order = np.argsort(side, kind="stable")
    nodes = table.column("node").to_numpy()[order]
    grams = table.column("grams").combine_chunks()
    ends = grams.offsets.to_numpy()
    values = grams.values.to_numpy()
    sets = [values[ends[i] : ends[i + 1]] for i in order.tolist()]
    first = int(np.searchsorted(side[order], 1))
    a, b = linked_pairs(sets, 0 if first == len(sets) else first, percent)
    by_id = np.argsort(nodes, kind="stable")
    place = np.empty(len(nodes), np.int64)
    place[by_id] = np.arange(len(nodes))
    root = nodes[by_id][local_roots(len(nodes), place[a], place[b])[place]]
    tied = root != nodes
    return pa.table({"node": pa.array(nodes[tied], pa.int64()), "root": pa.array(root[tied], pa.int64())})


def first_grams(grams: np.ndarray, frequent: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The n-grams of a set that come first in its block's order: by count, then by hash.

    The order of ``close_neighbours`` for one set at a time, which tests hold to its definition.
    """
    taken = len(grams) + (-len(grams) * percent // 100) + 1
    count = np.zeros(len(grams), np.int64)
    if len(frequent):
        order = np.argsort(frequent)
        known, numbers = frequent[order], counts[order]
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        count = np.where(known[at] == grams, numbers[at], 0)
    return grams[np.lexsort((grams, count))[:taken]]


def close_neighbours(members: DataFrame, percent: int) -> DataFrame:
    """(signature, node) of members (block, node, grams): linked ones share a signature.

    Rows are dealt by n-gram, which tells how many members have it, and those that more than one has
    by member. A member leaves out the ``ceil(t s) - 1`` n-grams that most others have.
    """
    rest = F.expr(f"(size(grams) * {percent} + 99) div 100 - 1").alias("rest")
    each = members.select("block", "node", rest, F.explode("grams").alias("gram"))
    each = each.select(F.xxhash64("block", "gram").alias("signature"), "node", "rest")
    held_by = F.count(F.lit(1)).over(W.partitionBy("signature"))
    shared = each.withColumn("held_by", held_by).where("held_by > 1")
    place = F.row_number().over(W.partitionBy("node").orderBy(F.desc("held_by"), "signature"))
    return shared.withColumn("place", place).where("place > rest").select("signature", "node")


def jaccard_components(
    docs: DataFrame,
    n: int = 3,
    percent: int = 90,
    row_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: id, n_shingles (size of its set) and component_id, the least id reachable by links.

    Words are what ASCII white space separates, A-Z lower-cased. A text of fewer than ``n`` words
    is one n-gram; one without words, empty or null, has an empty set and is linked with nothing.
    Documents link when ``100 * intersection >= percent * union``. Equal sets become one node first,
    so copies never meet in a block. Repeated rows and rows that share an id fall into one component
    by that id. Other columns are not read. Sets are known by 64-bit hashes of their n-grams.
    """
    rows = docs.select(
        F.col(quoted(row_id)).alias("doc_id"), F.col(quoted(text)).cast("binary").alias("text")
    )
    id_field = field(rows, "doc_id")
    sets = staged(map_batches(rows, _sets, f"{id_field}, n long, {SET}", n))
    number = sets.count()

    def blocks_of(signed: DataFrame) -> DataFrame:
        """(node, block): nodes with a signature in common, directly or by others, form a block."""
        least = F.min("node").over(
            W.partitionBy("signature").orderBy("node").rowsBetween(W.unboundedPreceding, 0)
        )
        near = staged(signed.select("node", least.alias("least")).where("node <> least").distinct(), number)
        found = components(near.select(F.col("node").alias("a"), F.col("least").alias("b")))
        return found.withColumnRenamed("component", "block")

    blocks = staged(blocks_of(map_batches(rows, _signatures, "signature long, node long", n, percent)), number)

    classes = sets.where("n > 0").groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n")
    )

    def sized(found: DataFrame, size: Column) -> DataFrame:
        """Add the members of the row's block and their n-grams together."""
        sizes = found.groupBy("block").agg(F.count(F.lit(1)).alias("members"), F.sum(size).alias("grams_of"))
        return found.join(staged(sizes, number), "block")

    # Block sizes are known before texts are read, so the n-grams of large blocks need no join to be told.
    found = classes.join(blocks, F.col("set_a") == F.col("node"))
    members = staged(found.select("doc_id", "block", "node", "set_b", "n"), number)
    sizes = members.select("node", "block", "n").distinct()
    marked = sized(sizes, F.col("n"))
    blocks_large = marked.where(F.col("members") > CLOSE_ROWS).select("block").distinct()
    large = blocks_large.withColumn("large", F.lit(True))
    told = members.drop("n").join(large, "block", "left").withColumn("large", F.col("large").isNotNull())
    told = staged(told, number)
    # Texts meet the members once, by a sort-merge join at any size; from then on their n-grams do.
    texts_of = rows.join(told.hint("merge"), "doc_id").drop("doc_id")
    held_sets = staged(
        map_batches(texts_of, _members, "block long, node long, large boolean, grams array<long>", n)
    )
    if not blocks_large.isEmpty():
        close = held_sets.where("large").select("block", "node", "grams")
        again = blocks_of(close_neighbours(close, percent))
        kept = marked.where(F.col("members") <= CLOSE_ROWS).select("node", "block")
        marked = sized(staged(kept.unionByName(again), number).join(sizes.drop("block"), "node"), F.col("n"))
    tiles = F.greatest(F.ceil(F.col("grams_of") / F.lit(TILE_GRAMS)), F.ceil(F.col("members") / F.lit(TILE_ROWS)))
    dealt_to = staged(marked.select("node", "block", tiles.alias("tiles")), number)
    full = held_sets.select("node", "grams").join(dealt_to.hint("merge"), "node")
    dealt = full.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    dealt = dealt.select("block", "node", "grams", "tile", other)
    dealt = dealt.select(
        "block",
        F.least("tile", "other").alias("i"),
        F.greatest("tile", "other").alias("j"),
        (F.col("tile") > F.col("other")).cast("int").alias("side"),
        "node",
        "grams",
    )
    ties = staged(
        dealt.groupBy("block", "i", "j").applyInArrow(
            lambda table: _tile(table, percent), "node long, root long"
        )
    )
    unstaged(held_sets)
    joined = components(ties.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = classes.select("set_a", "set_b", "doc_id").join(
        joined.withColumnRenamed("node", "set_a"), "set_a", "left"
    )
    linked = linked.withColumn("component", F.coalesce("component", "set_a"))
    lowest = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = linked.join(lowest, "component").select("set_a", "set_b", "component_id")
    result = sets.join(linked, ["set_a", "set_b"], "left")
    return result.select(
        F.col("doc_id").alias(row_id),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
