"""Merkle manifest of a table: one tree per group over its rows, one tree over the groups' roots.

A row's leaf hashes its named columns. Rows of a group (null counts as one group, and comes first)
ascend by id, null ids first and equal ids by leaf. At every level each run of ``arity`` consecutive
nodes becomes one parent, the last run may be shorter, and a single node that remains is the root.

Every level is an equijoin of the level with itself on computed sibling places (the place XOR 1 for
binary trees, else one join per offset in the run); rows in slot zero then emit the parents. Levels
are written tables, so a lost executor costs one level, and halve in size, so all joins together are
about two passes over one short row per document. Paths travel from the root down the same levels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mishap.llm.common import quoted, staged

PLACE_BITS = 33  # monotonically_increasing_id: partition above, place in the partition below
STEP = "struct<left: binary, right: binary>"


def field_bytes(name: str) -> Column:
    """A value as its UTF-8 length, a colon and its text (integers decimal), or a dash for null."""
    text = F.col(quoted(name)).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[str | Column]) -> Column:
    """sha256 (binary) over the encoded fields; a Column stands for an encoded field itself."""
    return _digest(*[f if isinstance(f, Column) else field_bytes(f) for f in fields])


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered(df: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """Number the rows of a written table from 0 in the order of ``keys``, without a single sorter.

    Rows are dealt by ranges of the keys and sorted inside each task; the tasks' row counts, one row
    per task, are summed up to offsets. Equal rows are told apart by their place in the files, so a
    key repeated in many rows spreads over tasks.
    """
    order = [F.col(quoted(k)).asc_nulls_first() for k in keys]
    marked = staged(df.withColumn("_row", F.monotonically_increasing_id()))
    dealt = marked.repartitionByRange(*order, "_row").sortWithinPartitions(*order, "_row")
    sorted_rows = staged(dealt.drop("_row").withColumn("_at", F.monotonically_increasing_id()))
    task = F.shiftright("_at", PLACE_BITS).alias("_task")
    sizes = sorted_rows.groupBy(task).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    starts = staged(sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    within = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (
        sorted_rows.withColumn("_task", F.shiftright("_at", PLACE_BITS))
        .join(starts, "_task")
        .withColumn(place, F.col("_start") + within)
        .drop("_task", "_start", "_at")
    )


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """(tree, size, place, digest, left, right): the digests of the run's others, joined by place."""
    slot = F.col("place") % arity
    found = nodes
    for offset in range(1, arity):
        if arity == 2:
            place = F.col("place").bitwiseXOR(F.lit(1))
        else:
            place = F.col("place") - slot + (slot + offset) % arity
        other = nodes.select("tree", F.col("place").alias("_place"), F.col("digest").alias(f"_{offset}"))
        found = found.withColumn("_place", place).join(other, ["tree", "_place"], "left").drop("_place")
    nothing = F.lit(b"")

    def side(wrapped: bool) -> Column:
        # Offsets that wrap around lie left of the node; both sides are ascending in the offset.
        parts = [
            F.when((slot + o >= arity) == wrapped, F.coalesce(F.col(f"_{o}"), nothing)).otherwise(nothing)
            for o in range(1, arity)
        ]
        return F.concat(*parts)

    return found.select("tree", "size", "place", "digest", side(True).alias("left"), side(False).alias("right"))


def _joined(step: Column, own: Column) -> Column:
    return _digest(hexed(step["left"]), hexed(own), hexed(step["right"]))


def _levels(nodes: DataFrame, arity: int, largest: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels with more than one node (with siblings), and (tree, digest) of the roots."""
    levels, roots = [], nodes.where("size = 1").select("tree", "digest")
    while largest > 1:
        level = staged(_with_siblings(nodes.where("size > 1"), arity))
        levels.append(level)
        largest = -(-largest // arity)
        own = F.struct("left", "right")
        nodes = level.where(F.col("place") % arity == 0).select(
            "tree",
            F.ceil(F.col("size") / arity).cast("long").alias("size"),
            F.expr(f"place div {arity}").alias("place"),
            _joined(own, F.col("digest")).alias("digest"),
        )
        roots = roots.unionByName(nodes.where("size = 1").select("tree", "digest"))
    return levels, staged(roots)


def _paths(levels: list[DataFrame], arity: int) -> DataFrame:
    """(tree, place, path) of the lowest level: from the top down, a node's step goes before its parent's."""
    above = None
    for level in reversed(levels):
        step = F.array(F.struct("left", "right"))
        nodes = level.select("tree", "place", step.alias("step"))
        if above is None:
            above = staged(nodes.withColumnRenamed("step", "path"))
            continue
        parents = above.select("tree", F.col("place").alias("_up"), "path")
        joined = nodes.withColumn("_up", F.expr(f"place div {arity}")).join(parents, ["tree", "_up"], "left")
        rest = F.coalesce("path", F.array().cast(f"array<{STEP}>"))
        above = staged(joined.select("tree", "place", F.concat("step", rest).alias("path")))
    return above


@dataclass(frozen=True)
class Manifest:
    """``rows``: the input's kept columns with leaf, subroot, root (binary) and path, root by root."""

    rows: DataFrame


def manifest(
    docs: DataFrame,
    fields: Sequence[str],
    row_id: str = "doc_id",
    group: str = "lang",
    arity: int = 2,
    keep: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of a table: for every row its leaf, its path of siblings, its group's root and the root.

    Returned rows have ``row_id``, ``group``, the columns of ``keep`` (name to expression over the
    input), ``leaf``, ``path`` (from the leaf up; a step holds the digests left and right of the
    node), ``subroot`` and ``root``. Repeated rows each have a place of their own. An empty table
    has no rows and no root. Other columns of the input play no part, whatever their names.
    """
    if arity < 2:
        raise ValueError("a run needs at least two nodes")
    kept = {f"k{i}": column for i, column in enumerate((keep or {}).values())}
    leaves = docs.select(
        F.col(quoted(row_id)).alias("id"),
        F.col(quoted(group)).alias("grp"),
        leaf_digest(fields).alias("leaf"),
        *[column.alias(name) for name, column in kept.items()],
    )
    placed = numbered(leaves, ["grp", "id", "leaf"], "at")
    sizes = placed.groupBy("grp").agg(F.min("at").alias("tree"), F.count(F.lit(1)).alias("size"))
    sizes = staged(sizes)
    same = F.col("grp").eqNullSafe(F.col("_grp"))
    rows = placed.join(sizes.withColumnRenamed("grp", "_grp"), same).drop("_grp")
    rows = staged(rows.withColumn("place", F.col("at") - F.col("tree")).drop("at"))

    # A group's tree is named by the place of its first row, so names ascend as groups do.
    nodes = rows.select("tree", "size", "place", F.col("leaf").alias("digest"))
    levels, subroots = _levels(nodes, arity, sizes.agg(F.max("size")).first()[0] or 0)
    tops = numbered(subroots.withColumnRenamed("tree", "group_tree"), ["group_tree"], "place")
    n_groups = tops.count()
    whole = [F.lit(0).cast("long").alias("tree"), F.lit(n_groups).cast("long").alias("size")]
    tops = staged(tops.select(*whole, "place", "digest", "group_tree"))
    top_levels, root = _levels(tops.drop("group_tree"), arity, n_groups)

    none = F.array().cast(f"array<{STEP}>")
    heads = tops.select("tree", "place", "group_tree", F.col("digest").alias("subroot"))
    if top_levels:
        heads = heads.join(_paths(top_levels, arity).withColumnRenamed("path", "head"), ["tree", "place"])
    else:
        heads = heads.withColumn("head", none)
    heads = heads.join(root.withColumnRenamed("digest", "root"), "tree")
    heads = staged(heads.select(F.col("group_tree").alias("tree"), "subroot", "root", "head"))

    if levels:
        rows = rows.join(_paths(levels, arity), ["tree", "place"], "left")
    else:
        rows = rows.withColumn("path", none)
    rows = rows.join(heads, "tree")
    path = F.concat(F.coalesce("path", none), "head").alias("path")
    named = [F.col(k).alias(name) for k, name in zip(kept, keep or {})]
    return Manifest(
        rows.select(F.col("id").alias(row_id), F.col("grp").alias(group), *named, "leaf", path, "subroot", "root")
    )


def proof_digest(path: Column) -> Column:
    """sha256 in hex over all siblings of a path, from the leaf up, left before right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: hexed(F.concat(s["left"], s["right"]))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root in hex that a leaf (binary) leads to along a path."""
    return F.aggregate(
        path, hexed(leaf), lambda own, s: F.sha2(F.concat(hexed(s["left"]), own, hexed(s["right"])), 256)
    )


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def audit(docs: DataFrame, every: int = 7, arity: int = 2) -> DataFrame:
    """Manifest of documents and the check of a copy in which some rows' ``n_chars`` grew by one.

    Rows are tampered with where ``every`` divides the unsigned crc32 of the decimal id; null ids
    and null ``n_chars`` stay as they are. Per document: id, leaf, subroot, root, digest of the
    proof, the root that the (tampered) leaf folds to, and whether that is the root.
    """
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    grown = F.coalesce(F.col("n_chars").cast("decimal(38,0)") + F.when(picked, 1).otherwise(0), F.col("n_chars"))
    size = F.coalesce(
        F.concat(F.octet_length(grown.cast("string")).cast("string"), F.lit(":"), grown.cast("string")), F.lit("-")
    )
    seen = leaf_digest([size if name == "n_chars" else name for name in FIELDS])
    found = manifest(docs, FIELDS, "doc_id", "lang", arity, {"seen": seen}).rows
    back = found.withColumn("folded_root", folded(F.col("seen"), F.col("path")))
    return back.select(
        "doc_id",
        hexed(F.col("leaf")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == hexed(F.col("root"))).alias("verified"),
    )
