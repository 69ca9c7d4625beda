"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

A paragraph hashes to a wide vector, a text to the sum of its paragraphs' vectors. Entries are added
modulo 2^64, each holding two counters modulo 2^32, so fingerprints can be added and subtracted:
order does not matter, and paragraphs can be inserted or removed without reading the rest. The
counters are of zeros and ones, and as signs they make the inner product of two fingerprints an
estimate of how many paragraphs the texts share.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mishap.llm.common import buckets, quoted

# Lines, and within lines sentences, are the paragraphs.
PARAGRAPH = r"\n|(?<=[.!?] )"
HASHES, SHIFTS = 2, 32
COUNTERS = 2 * HASHES * SHIFTS
ROWS_PER_BUCKET = 1_000
MAX_BUCKETS = 65_536
_LANES = (1 << 32) + 1


def paragraphs(text: Column, pattern: str = PARAGRAPH) -> Column:
    return F.split(text, pattern, -1)


def hashes(parts: Column) -> Column:
    """Hashes of every paragraph, one array for each of ``HASHES`` seeds."""

    def seeded(seed: int) -> Column:
        return F.transform(parts, lambda p: F.xxhash64(p, F.lit(seed)))

    return F.struct(*[seeded(seed).alias(f"h{seed}") for seed in range(HASHES)])


def fingerprint(hashed: Column) -> Column:
    """Sum of the vectors of paragraphs, given their hashes; the last entry is their number.

    ``hashed`` should be a column of an earlier projection, so that it is computed once.
    """

    def entry(seed: int, shift: int) -> Column:
        def plus(total: Column, h: Column) -> Column:
            return total + F.shiftright(h, shift).bitwiseAND(F.lit(_LANES))

        return F.aggregate(hashed[f"h{seed}"], F.lit(0).cast("long"), plus)

    entries = [entry(seed, shift) for seed in range(HASHES) for shift in range(SHIFTS)]
    return F.array(*entries, F.size(hashed["h0"]).cast("long"))


def add(a: Column, b: Column) -> Column:
    """Fingerprint of the texts' paragraphs together."""
    return F.zip_with(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint after the paragraphs of ``b`` are taken out."""
    return F.zip_with(a, b, lambda x, y: x - y)


def as_text(vector: Column) -> Column:
    """The fingerprint as lowercase hexadecimal digits, 16 for each entry."""
    return F.lower(F.array_join(F.transform(vector, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _product(a: Column, b: Column) -> Column:
    """Inner product of two fingerprints as vectors of signs."""
    n, m = F.element_at(a, -1), F.element_at(b, -1)

    def signs(x: Column, count: Column) -> tuple[Column, Column]:
        low = 2 * x.bitwiseAND(F.lit((1 << 32) - 1)) - count
        return low, 2 * F.shiftrightunsigned(x, 32) - count

    def both(x: Column, y: Column) -> Column:
        (x0, x1), (y0, y1) = signs(x, n), signs(y, m)
        return x0.cast("double") * y0 + x1.cast("double") * y1

    pairs = F.zip_with(F.slice(a, 1, COUNTERS // 2), F.slice(b, 1, COUNTERS // 2), both)
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common paragraphs of two fingerprints, 0 to 1; 1 if they are equal."""
    share = 2 * _product(a, b) / (_product(a, a) + _product(b, b))
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def with_next(docs: DataFrame, row_id: str, text: str) -> DataFrame:
    """(id, text, next_text) with the text of the next row in descending order of id.

    The row after the last is the first. Rows fall into ranges of the id by its quantiles, which a
    pass over the ids finds; each range is ordered in its own task. The last row of a range is
    followed by the first of the next range that has rows: those boundary rows are looked up by id.
    """
    rows = docs.select(
        F.col(quoted(row_id)).alias("id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text")
    )
    place = F.col("id").cast("double")
    total = rows.count()
    many = min(MAX_BUCKETS, buckets(total, ROWS_PER_BUCKET))
    cuts = []
    if many > 1:
        steps = F.lit(np.linspace(0, 1, many + 1)[1:-1])
        cuts = rows.agg(F.percentile_approx(place, steps, 10 * many)).first()[0] or []
    # Ranges count down with the id; ids that are null come last.
    dealt = rows.withColumn("_place", place).withColumn("_number", F.lit(0.0))
    if cuts:
        splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
        ranges = Bucketizer(
            splits=splits, inputCol="_place", outputCol="_number", handleInvalid="keep"
        )
        dealt = ranges.transform(dealt.drop("_number"))
    order = F.when(F.col("id").isNull(), 1).otherwise(-F.col("_number").cast("int"))
    dealt = dealt.select("id", "text", order.alias("_range"))

    # Only the range of the least ids and that of null ids can be empty.
    tie = F.xxhash64("text")
    edges = dealt.groupBy("_range").agg(F.max("id").alias("id")).collect()
    ranges = sorted(r["_range"] for r in edges) or [0]
    place = F.col("_range")
    ahead = F.when(place == ranges[0], ranges[-1]).otherwise(place - 1)
    if 0 not in ranges:
        ahead = F.when(place == 1, -1 if len(ranges) > 1 else 1).otherwise(ahead)
    leading = F.col("id").isin([r["id"] for r in edges if r["id"] is not None])
    # Rows that share the id of a boundary: the first in order.
    leads = (
        dealt.where(leading | F.col("id").isNull())
        .groupBy("_range")
        .agg(F.min_by("text", F.struct(tie.alias("t"), "text")).alias("_head"))
        .select(ahead.alias("_range"), "_head")
    )
    within = W.partitionBy("_range").orderBy(F.col("id").desc_nulls_last(), tie, "text")
    ordered = dealt.withColumns(
        {
            "_next": F.lead("text").over(within),
            "_inner": F.lead(F.lit(True)).over(within).isNotNull(),
        }
    )
    joined = ordered.join(leads, "_range", "left")
    following = F.when(F.col("_inner"), F.col("_next")).otherwise(F.col("_head"))
    return joined.select("id", "text", following.alias("next_text"))


def compare_with_edits(
    docs: DataFrame, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprints of every text, of an edited copy and of the next text, and their likeness.

    In the edited copy the last half of the characters is replaced by as many of the next text's
    first, or all of it if it is shorter. The next row is the one with the next smaller id, the
    first after the last; among rows of one id the hash of the text decides. A null text counts as
    empty, an empty text has one empty paragraph, and a table of one row is its own next.
    """
    rows = with_next(docs, row_id, text)
    half = F.floor(F.length("text") / 2).cast("int")
    kept = F.substring("text", F.lit(1), F.length("text") - half)
    rows = rows.select(
        "id",
        "text",
        "next_text",
        F.length("text").cast("long").alias("n_chars"),
        F.concat(kept, F.substring("next_text", F.lit(1), half)).alias("edited"),
    )
    rows = rows.select(
        "id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        *[
            hashes(paragraphs(F.col(source))).alias(name)
            for source, name in (("text", "a"), ("edited", "b"), ("next_text", "c"))
        ],
    )
    rows = rows.select(
        "id", "n_chars", "edited_sha256", *[fingerprint(F.col(c)).alias(c) for c in "abc"]
    )
    return rows.select(
        F.col("id").alias(row_id),
        "n_chars",
        "edited_sha256",
        as_text(F.col("a")).alias("fingerprint"),
        as_text(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"),
        likeness(F.col("a"), F.col("c")).alias("near_next"),
    )
