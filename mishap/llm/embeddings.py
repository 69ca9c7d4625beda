"""Near-duplicate vectors: int8 tile products with error bounds, exact where they cannot decide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap.llm.common import quoted, staged
from mishap.llm.graphs import components, local_roots

TILE_VALUES = 1 << 17
PAIRS_AT_ONCE = 1 << 16


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as int8 with one scale each, and the length of what rounding left out."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - q * scale[:, None], axis=1)
    return q, scale, error


def linked_pairs(x: np.ndarray, y: np.ndarray, same: bool, threshold: float):
    """Index pairs of rows of two tiles with cosine >= threshold; each pair once if the tiles are one.

    With x = s q + e, the product of unit vectors differs from s_x s_y (q_x . q_y) by at most
    |e_x| + (1 + |e_x|) |e_y|. Only pairs that this leaves open are multiplied in double precision.
    """
    norm_x, norm_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    qx, sx, ex = quantise(x / norm_x[:, None])
    qy, sy, ey = quantise(y / norm_y[:, None])
    # Integer products stay exact in floating point below 2^24 (single) and 2^53 (double).
    exact = np.float32 if 127 * 127 * x.shape[1] < 1 << 24 else np.float64
    qy, found = qy.astype(exact).T.copy(), []
    step = max(1, (1 << 20) // max(1, len(y)))
    slack = 1e-9
    for start in range(0, len(x), step):
        rows = slice(start, start + step)
        product = (qx[rows].astype(exact) @ qy).astype(np.float64)
        product *= sx[rows, None] * sy
        product += ex[rows, None] + (1 + ex[rows, None]) * ey + slack
        a, b = np.nonzero(product >= threshold)
        a += start
        if same:
            a, b = a[a < b], b[a < b]
        for at in range(0, len(a), PAIRS_AT_ONCE):
            i, j = a[at : at + PAIRS_AT_ONCE], b[at : at + PAIRS_AT_ONCE]
            cosine = np.einsum("nd,nd->n", x[i], y[j]) / (norm_x[i] * norm_y[j])
            kept = cosine >= threshold
            found.append((i[kept], j[kept]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(part) for part in zip(*found))


def _tile(table: pa.Table, threshold: float) -> pa.Table:
    """Links within one pair of tiles: per node how many rows it links with, and a node it is tied to."""
    side = table.column("side").to_numpy()
    order = np.argsort(side, kind="stable")
    side = side[order]
    nodes, copies = (table.column(c).to_numpy()[order] for c in ("node", "copies"))
    column = table.column("vector").combine_chunks()
    vectors = column.flatten().to_numpy(zero_copy_only=False).reshape(len(side), -1)[order]
    first = int(np.searchsorted(side, 1))
    same = first == len(side)
    a, b = linked_pairs(vectors[:first], vectors if same else vectors[first:], same, threshold)
    b = b if same else b + first
    links = np.bincount(a, copies[b], len(side)) + np.bincount(b, copies[a], len(side))
    by_id = np.argsort(nodes)
    place = np.empty(len(nodes), np.int64)
    place[by_id] = np.arange(len(nodes))
    root = nodes[by_id][local_roots(len(nodes), place[a], place[b])[place]]
    tied = links > 0
    return pa.table(
        {
            "node": pa.array(nodes[tied], pa.int64()),
            "root": pa.array(root[tied], pa.int64()),
            "links": pa.array(links[tied].astype(np.int64)),
        }
    )


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.98,
    row_id: str = "vec_id",
    vector: str = "embedding",
    group: str = "label",
) -> DataFrame:
    """Per row: id, n_links (rows of its group at cosine >= threshold), component_id and kept.

    Equal vectors of a group become one node with a count first, so copies cost nothing further.
    Nodes are dealt to tiles of bounded size, and every pair of tiles of a group is one product; a
    group of any size spreads over its pairs of tiles. Tiles return link counts and one tie per
    node, never pairs. ``component_id`` is the least id reachable by links, ``kept`` marks the row
    that has it. Vectors that are null, empty, all zero or hold null or non-finite values, and rows
    without a group, link with nothing; so do vectors of different length. Repeated rows are rows:
    copies of a vector link with each other.
    """
    value = F.col(quoted(vector)).cast("array<double>")
    rows = vectors.select(
        F.col(quoted(row_id)).alias("id"), F.col(quoted(group)).alias("g"), value.alias("v")
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = (
        F.col("id").isNotNull()
        & F.col("g").isNotNull()
        & F.forall("v", finite)
        & F.exists("v", lambda x: x != 0)
    )
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    keyed = rows.where("usable").select(
        "id", "g", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.reverse("v"), "g").alias("k2")
    )
    nodes = keyed.groupBy("g", "k1", "k2").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("vector")
    )
    # Numbers are fixed by writing them.
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()))
    sized = nodes.withColumn("dim", F.size("vector"))
    tiles = sized.groupBy("g", "dim").agg(
        F.ceil(F.count(F.lit(1)) * F.col("dim") / F.lit(TILE_VALUES)).alias("tiles")
    )
    dealt = sized.join(tiles, ["g", "dim"]).withColumn(
        "tile", F.pmod(F.xxhash64("node"), F.col("tiles"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    dealt = dealt.select("g", "dim", "node", "copies", "vector", "tile", other)
    dealt = dealt.select(
        "g",
        "dim",
        F.least("tile", "other").alias("i"),
        F.greatest("tile", "other").alias("j"),
        (F.col("tile") > F.col("other")).cast("int").alias("side"),
        "node",
        "copies",
        "vector",
    )
    found = staged(
        dealt.groupBy("g", "dim", "i", "j").applyInArrow(
            lambda table: _tile(table, threshold), "node long, root long, links long"
        )
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classes = nodes.select("node", "g", "k1", "k2", "least", "copies").join(joined, "node", "left")
    classes = classes.withColumn("component", F.coalesce("component", "node"))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "component").join(links, "node", "left")
    classes = classes.select(
        "g", "k1", "k2", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    linked = keyed.select("id", "g", "k1", "k2").join(classes, ["g", "k1", "k2"])
    alone = rows.where("not usable").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    result = linked.select("id", "n_links", "component_id").unionByName(alone)
    return result.select(
        F.col("id").alias(row_id),
        F.col("n_links").cast("long").alias("n_links"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
