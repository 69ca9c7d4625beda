"""Exact-size samples and stratified splits by hashed order, without sorting the table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mishap import schemas as S
from mishap.operators.hygiene import quoted
from mishap.operators.joins import pin
from mishap.sources.tables import stage

KEY = "_key"
KEY_LENGTH = 32
ROW_KEY_LENGTH = 16
PREFIX_STEP = 4
TAIL_ROWS = 1_000_000
SALTS = 256


def hashed_order(row_id: str, seed: int = S.SEED) -> Column:
    """Random-looking text key of a row that depends only on the seed and the row's id."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(quoted(row_id)).cast("string")))


def _row_key(columns: Sequence[str]) -> Column:
    return F.lpad(F.hex(F.xxhash64(*columns)), ROW_KEY_LENGTH, "0")


def key_cutoffs(
    keyed: DataFrame,
    strata: Sequence[str],
    quota_of: Callable[[DataFrame], DataFrame],
    key_length: int = KEY_LENGTH,
) -> DataFrame:
    """Per stratum, the key of its ``quota``-th row in key order: (strata, _cutoff, _n, _need).

    ``_n`` rows have the cutoff key, and ``_need`` of them belong to the quota. Rows are counted by
    a key prefix of four hex digits, so a stratum yields at most 65,536 counts whatever its size.
    The sums of those counts are the stratum sizes (strata, rows) from which ``quota_of`` derives
    (strata, quota). The prefix in which a quota falls is refined the same way until at most
    ``TAIL_ROWS`` rows share it, which are counted by their whole key. A stratum with quota 0 has
    no cutoff.
    """
    strata = list(strata)
    keyed = keyed.select(*strata, KEY)
    upto = F.sum("_n").over(W.partitionBy(*strata).orderBy("_prefix"))

    def counted(rows: DataFrame, length: int) -> DataFrame:
        prefix = F.substring(KEY, 1, length).alias("_prefix")
        return rows.groupBy(*strata, prefix).agg(F.count(F.lit(1)).alias("_n"))

    def edges(counts: DataFrame, needed: DataFrame) -> DataFrame:
        found = counts.withColumn("_upto", upto).join(needed, strata)
        found = found.where("_upto >= _need and _upto - _n < _need")
        return pin(
            found.select(*strata, "_prefix", "_n", F.expr("_need - (_upto - _n)").alias("_need"))
        )

    counts = pin(counted(keyed, PREFIX_STEP))
    sizes = counts.groupBy(*strata).agg(F.sum("_n").alias("rows"))
    quotas = quota_of(sizes).where("quota > 0")
    edge = edges(counts, quotas.select(*strata, F.col("quota").alias("_need")))
    length = PREFIX_STEP
    while length < key_length:
        few = edge.where(F.col("_n") > TAIL_ROWS).isEmpty()
        rest = (
            keyed.join(edge.select(*strata, "_prefix"), strata)
            .where(F.substring(KEY, 1, length) == F.col("_prefix"))
            .drop("_prefix")
        )
        length = key_length if few else length + PREFIX_STEP
        edge = edges(counted(rest, length), edge.select(*strata, "_need"))
    return edge.select(*strata, F.col("_prefix").alias("_cutoff"), "_n", "_need")


def mark_first(
    df: DataFrame,
    strata: Sequence[str],
    row_id: str,
    quota_of: Callable[[DataFrame], DataFrame],
    seed: int = S.SEED,
) -> DataFrame:
    """Add ``_picked``: true for exactly the quota of each stratum, the first rows in hashed order.

    Rows that share the id at the cutoff are ordered by a hash of all their columns, and of equal
    rows as many are picked as the quota still needs. Equal rows are counted per salt, the quota is
    handed to the salts by a prefix sum, and rows are numbered within their salt, so a group of
    equal rows of any size spreads over all tasks.
    """
    strata = list(strata)
    names = [c for c in df.columns if c not in (KEY, "_picked")]
    keyed = df.select(*map(quoted, names), hashed_order(row_id, seed).alias(KEY))
    cut = pin(key_cutoffs(keyed, strata, quota_of))
    marked = keyed.join(cut, strata, "left")
    below = F.coalesce(F.col(KEY) <= F.col("_cutoff"), F.lit(False))
    if cut.where("_n > _need").isEmpty():
        return marked.select(*map(quoted, names), below.alias("_picked"))

    tied = F.coalesce((F.col(KEY) == F.col("_cutoff")) & (F.col("_n") > F.col("_need")), F.lit(False))
    clear = marked.where(~tied).select(*map(quoted, names), below.alias("_picked"))
    ties = marked.where(tied).select(*map(quoted, names), _row_key([*map(quoted, names)]).alias(KEY))
    needs = cut.where("_n > _need").select(*strata, F.col("_need").alias("quota"))
    edge = pin(key_cutoffs(ties, strata, lambda sizes: sizes.join(needs, strata), ROW_KEY_LENGTH))
    ties = ties.join(edge, strata, "left")
    equal = F.col(KEY) == F.col("_cutoff")
    rest = ties.where(~equal).withColumn("_picked", F.col(KEY) < F.col("_cutoff"))
    columns = [*map(quoted, names), "_picked"]
    ranked = pick_equal(ties.where(equal).select(*map(quoted, names), "_need"), strata)
    return clear.unionByName(rest.select(*columns)).unionByName(ranked.select(*columns))


def pick_equal(rows: DataFrame, strata: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Mark ``_need`` rows of each stratum, any of them: all rows of a stratum are equal.

    The salt is the row's place in its task, so the rows are written once; salts of a stratum hold
    almost equally many rows.
    """
    salted = stage(rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts))), "ties")
    by_salt = W.partitionBy(*strata).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    counts = salted.groupBy(*strata, "_salt").agg(F.count(F.lit(1)).alias("_in"), F.first("_need").alias("_n"))
    before = F.coalesce(F.sum("_in").over(by_salt), F.lit(0))
    share = F.least(F.col("_in"), F.greatest(F.col("_n") - before, F.lit(0)))
    shares = pin(counts.withColumn("_share", share).select(*strata, "_salt", "_share"))
    place = F.row_number().over(W.partitionBy(*strata, "_salt").orderBy(F.lit(0)))
    joined = salted.withColumn("_place", place).join(shares, [*strata, "_salt"])
    return joined.withColumn("_picked", F.col("_place") <= F.col("_share")).drop(
        "_salt", "_share", "_place", "_need"
    )


def split_quotas(sizes: DataFrame, label: str, test_fraction: float = 0.2) -> DataFrame:
    """Test rows per class, from the class sizes: a fixed total shared out by largest remainder.

    The total is the test fraction of all rows, rounded up. The training rows are shared out in
    proportion and the test rows are what is left of each class; equal remainders go to the lesser
    class name. Works on one row per class.
    """
    whole_table = W.partitionBy()
    exact = "decimal(19,0)"
    shared = (
        sizes.withColumn("_total", F.sum("rows").over(whole_table))
        .withColumn("_train", F.col("_total") - F.ceil(F.col("_total") * F.lit(test_fraction)))
        .withColumn("_product", F.col("rows").cast(exact) * F.col("_train").cast(exact))
        .withColumn("_whole", F.expr("_product div _total"))
        .withColumn("_left", F.expr("_product % _total"))
        .withColumn("_order", F.row_number().over(whole_table.orderBy(F.desc("_left"), quoted(label))))
        .withColumn("_spare", F.col("_train") - F.sum("_whole").over(whole_table))
    )
    extra = F.when(F.col("_order") <= F.col("_spare"), 1).otherwise(0)
    quota = (F.col("rows") - F.col("_whole") - extra).cast("long")
    return shared.select(quoted(label), "rows", quota.alias("quota"))


def stratified_split(
    df: DataFrame,
    row_id: str,
    label: str,
    test_fraction: float = 0.2,
    seed: int = S.SEED,
) -> DataFrame:
    """Add ``split``: 'test' for the exact quota of each class in hashed order, else 'train'.

    The class quotas and cutoffs are a few rows found in narrow passes over id and label; marking
    the rows is then a lookup, so the wide table is not shuffled. Ids may repeat or be missing: the
    quotas are exact for any rows. Rows without a label are taken to be filtered out.
    """
    marked = mark_first(
        df, [label], row_id, lambda sizes: split_quotas(sizes, label, test_fraction), seed
    )
    split = F.when(F.col("_picked"), "test").otherwise("train")
    return marked.withColumn("split", split).select(*map(quoted, df.columns), "split")


def exact_sample(df: DataFrame, row_id: str, limit: int, seed: int = S.SEED) -> DataFrame:
    """``min(limit, rows)`` rows without replacement: the first in hashed order, in no order.

    The cutoff key is found from prefix counts, so the sample is a filter of the scan.
    """
    quota = F.least(F.col("rows"), F.lit(limit)).alias("quota")
    whole = df.withColumn("_all", F.lit(1))
    marked = mark_first(whole, ["_all"], row_id, lambda sizes: sizes.select("_all", quota), seed)
    return marked.where("_picked").select(*map(quoted, df.columns))


def least_hashed(
    df: DataFrame, row_id: str, group: str | None, limit: int, seed: int = S.SEED, salts: int = 64
) -> DataFrame:
    """The ``limit`` rows of every group that come first in hashed order, for all groups in one pass.

    Each task keeps its first ``limit`` rows per group, ``salts`` sets of tasks merge theirs, then
    those are merged: what the last merge of a group reads depends on the limit alone. Without a
    group the whole table is one. Rows that share an id go by the hash of all columns; of equal rows
    any are taken. A null group is a group of its own.
    """
    names = [quoted(c) for c in df.columns]
    groups = [] if group is None else [quoted(group)]
    salt = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt")
    keyed = df.select(*names, hashed_order(row_id, seed).alias(KEY), _row_key(names).alias("_tie"), salt)
    for by in ([*groups, "_salt"], groups or [F.lit(0)]):
        first = F.row_number().over(W.partitionBy(*by).orderBy(KEY, "_tie"))
        keyed = keyed.withColumn("_place", first).where(F.col("_place") <= limit)
    return keyed.select(*names)
