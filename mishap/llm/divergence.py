"""How the sources of a language differ in their word frequencies, exactly and in integers.

Single-pass in-memory indexing: a task builds postings for a block of documents until its memory
budget is filled, then spills the block as a run sorted by term, cut into short chunks and dealt to
hash shards. A shard receives the chunks of all runs in order of their first term and merges them
with a heap; a chunk is opened when its first term is due, so memory holds one chunk per run at most,
never a shard. Only terms in enough documents leave the merge, with one count per source.

Divergences are then sums over terms. For most pairs of sources and most terms both counts are zero,
so a pair starts from a closed form and blocks of terms stream corrections to it.
"""

from __future__ import annotations

import heapq
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, repeat
from operator import itemgetter
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mishap.llm.common import SLICE, map_batches, quoted, staged

SCALE, PRIOR = 1_000_000_000, 5

class Limits(NamedTuple):
    """Bounds of memory; none changes the result.

    A block is spilled at so many postings, terms or bytes of terms; a chunk of a run has so many
    terms; corrections are computed for pairs of tiles of sources and blocks of terms (on average).
    """

    postings: int = 2_000_000
    terms: int = 300_000
    term_bytes: int = 1 << 25
    chunk: int = 256
    tile: int = 256
    block: int = 4_096


_CHUNK_SCHEMA = "shard int, lang binary, first binary, terms binary, docs binary, sizes binary, sources array<binary>, codes binary, counts binary"
# Bytes of terms stay, in lower case for A-Z; all others become spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """Occurrences of every term: runs of ASCII letters (A-Z in lower case) and non-ASCII characters."""
    folded = text.translate(_FOLD)
    found: Counter = Counter()
    start = 0
    while len(folded) - start > 2 * SLICE and (cut := folded.find(b" ", start + SLICE)) >= 0:
        found.update(folded[start:cut].split())
        start = cut
    found.update(folded[start:].split() if start else folded.split())
    return found


class _Block:
    """Postings of the documents since the last spill: (term, group, occurrences) per document."""

    def __init__(self, limits: Limits) -> None:
        self.limits = limits
        self.terms: list[tuple[bytes, bytes]] = []
        self.ids: dict[bytes, dict[bytes, int]] = {}
        self.groups: dict[tuple[bytes, bytes], int] = {}
        self.term, self.count = array("i"), array("q")
        self.group, self.size = array("i"), array("i")
        self.bytes = 0

    def add(self, lang: bytes, source: bytes, counts: Counter) -> None:
        ids = self.ids.setdefault(lang, {})
        new = [t for t in counts if t not in ids]
        ids.update(zip(new, range(len(self.terms), len(self.terms) + len(new))))
        self.terms.extend(zip(repeat(lang), new))
        self.bytes += sum(map(len, new))
        self.term.extend(map(ids.__getitem__, counts))
        self.count.extend(counts.values())
        self.group.append(self.groups.setdefault((lang, source), len(self.groups)))
        self.size.append(len(counts))

    @property
    def full(self) -> bool:
        most = self.limits
        return (
            len(self.term) >= most.postings or len(self.terms) >= most.terms or self.bytes >= most.term_bytes
        )

    def run(self, shards: int) -> Iterator[tuple]:
        """The block's chunks: per shard and language in order of term."""
        if not self.terms:
            return
        shard = [crc32(term) % shards for _, term in self.terms]
        order = sorted(range(len(self.terms)), key=lambda i: (shard[i], self.terms[i]))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at = place[np.frombuffer(self.term, np.int32)]
        group = np.repeat(np.frombuffer(self.group, np.int32), np.frombuffer(self.size, np.int32))
        docs = np.bincount(at, minlength=len(order))
        key = at * len(self.groups) + group
        by_key = np.argsort(key, kind="stable")
        key = key[by_key]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sums = np.add.reduceat(np.frombuffer(self.count, np.int64)[by_key], starts)
        owner, code = np.divmod(key[starts], len(self.groups))
        ends = np.searchsorted(owner, np.arange(len(order) + 1))
        sources = [source for _, source in self.groups]
        position = 0
        for (number, lang), part in groupby(order, lambda i: (shard[i], self.terms[i][0])):
            terms = [self.terms[i][1] for i in part]
            for cut in range(0, len(terms), self.limits.chunk):
                some = terms[cut : cut + self.limits.chunk]
                low, high = position + cut, position + cut + len(some)
                inner = slice(ends[low], ends[high])
                used, local = np.unique(code[inner], return_inverse=True)
                yield (
                    number, lang, some[0], b" ".join(some), docs[low:high].tobytes(),
                    np.diff(ends[low : high + 1]).tobytes(), [sources[c] for c in used],
                    local.astype(np.int64).tobytes(), sums[inner].tobytes(),
                )
            position += len(terms)


def _columns(rows: list[tuple], names: list[str]) -> dict:
    return dict(zip(names, zip(*rows)))


def _spill(batches: Iterator[pa.RecordBatch], shards: int, limits: Limits) -> Iterator[dict]:
    names = [c.split()[0] for c in _CHUNK_SCHEMA.split(", ")]
    block, rows = _Block(limits), []

    def spilled() -> Iterator[dict]:
        rows.clear()
        for row in block.run(shards):
            rows.append(row)
            if len(rows) == 1000:
                yield _columns(rows, names)
                rows.clear()
        if rows:
            yield _columns(rows, names)

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
            block.add(lang.as_py(), source.as_py(), term_counts(text.as_py()))
            if block.full:
                yield from spilled()
                block = _Block(limits)
    yield from spilled()


class _Cursor:
    """A place in an open chunk."""

    def __init__(self, row: dict):
        self.terms = row["terms"].split(b" ")
        self.docs = np.frombuffer(row["docs"], np.int64).tolist()
        self.ends = np.cumsum(np.frombuffer(row["sizes"], np.int64)).tolist()
        self.sources, self.row = row["sources"], row

    def postings(self, i: int) -> Iterator[tuple[bytes, int]]:
        low, high = self.ends[i - 1] if i else 0, self.ends[i]
        codes = np.frombuffer(self.row["codes"], np.int64, high - low, 8 * low).tolist()
        counts = np.frombuffer(self.row["counts"], np.int64, high - low, 8 * low).tolist()
        return zip(map(self.sources.__getitem__, codes), counts)


def merged(chunks: Iterator[dict]) -> Iterator[tuple[bytes, list[tuple[_Cursor, int]]]]:
    """Each term of sorted runs, once and in order, with its places in their chunks.

    ``chunks`` come in order of their first term.
    """
    heap: list[tuple[bytes, int, int, _Cursor]] = []
    due, opened = next(chunks, None), 0
    while heap or due is not None:
        while due is not None and (not heap or due["first"] <= heap[0][0]):
            cursor = _Cursor(due)
            heapq.heappush(heap, (cursor.terms[0], opened, 0, cursor))
            due, opened = next(chunks, None), opened + 1
        term, places = heap[0][0], []
        # A chunk that starts with this very term is opened before the term is complete.
        while heap and heap[0][0] == term:
            _, number, i, cursor = heap[0]
            places.append((cursor, i))
            if i + 1 < len(cursor.terms):
                heapq.heapreplace(heap, (cursor.terms[i + 1], number, i + 1, cursor))
            else:
                heapq.heappop(heap)
        yield term, places


def _merge(batches: Iterator[pa.RecordBatch], least_docs: int) -> Iterator[dict]:
    def rows() -> Iterator[dict]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield {name: column[row].as_py() for name, column in zip(batch.schema.names, batch.columns)}

    names = ["lang", "term", "sources", "counts"]
    ready, entries = [], 0
    for (_, lang), chunks in groupby(rows(), itemgetter("shard", "lang")):
        for term, places in merged(chunks):
            if sum(cursor.docs[i] for cursor, i in places) < least_docs:
                continue
            total: Counter = Counter()
            for cursor, i in places:
                for source, n in cursor.postings(i):
                    total[source] += n
            ready.append((lang, term, list(total), list(total.values())))
            entries += len(total)
            if entries > 50_000:
                yield _columns(ready, names)
                ready, entries = [], 0
    if ready:
        yield _columns(ready, names)


def frequencies(
    docs: DataFrame, least_docs: int, text: str = "text", lang: str = "lang", source: str = "source",
    shards: int | None = None, limits: Limits = Limits(),
) -> DataFrame:
    """(lang, term, sources, counts) of the terms in at least ``least_docs`` documents of a language.

    Null texts, languages and sources are empty; repeated rows count each. There are as many shards
    as shuffle partitions unless a number is given.
    """
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(*[
        F.coalesce(F.col(quoted(c)), F.lit("")).cast("binary").alias(name)
        for c, name in ((text, "text"), (lang, "lang"), (source, "source"))
    ])
    runs = map_batches(named, _spill, _CHUNK_SCHEMA, shards, limits)
    dealt = runs.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "lang", "first")
    found = map_batches(
        dealt, _merge, "lang binary, term binary, sources array<binary>, counts array<bigint>", least_docs
    )
    return found.select(
        F.col("lang").cast("string"), F.col("term").cast("string"),
        F.col("sources").cast("array<string>").alias("sources"), "counts",
    )


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)) in exact arithmetic."""
    wide = "decimal(38,0)"
    over = (F.lit(SCALE).cast(wide) * (count + F.lit(PRIOR)).cast("decimal(28,0)")).cast(wide)
    return F.call_function("div", over, (total + F.lit(PRIOR) * terms).cast(wide)) + F.lit(1)


def _pair_block(key: tuple, entries: pa.Table, tiles: pa.Table) -> pa.Table:
    """Corrections of all pairs of sources of two tiles by the terms of one block."""
    lang, a, b, _ = (k.as_py() for k in key)
    names = tiles["source"].combine_chunks()
    zero, tile = tiles["zero"].to_numpy(), tiles["tile"].to_numpy()
    terms = entries["term"].combine_chunks().dictionary_encode()
    rare = np.repeat(zero[None, :], len(terms.dictionary), 0)
    place = pc.index_in(entries["source"].combine_chunks(), names).to_numpy()
    rare[terms.indices.to_numpy(), place] = entries["p"].to_numpy()
    left, right = np.flatnonzero(tile == a), np.flatnonzero(tile == b)
    others, base = rare[:, right], zero[right]
    first, second, sums = [], [], []
    for i in left:
        sums.append(np.abs(rare[:, [i]] - others).sum(0) - len(rare) * np.abs(zero[i] - base))
        first.append(np.full(len(right), i))
        second.append(right)
    if not first or not len(right):
        return _PAIRS.empty_table()
    x, y, change = map(np.concatenate, (first, second, sums))
    if a != b:
        x, y, change = np.r_[x, y], np.r_[y, x], np.r_[change, change]
    used = (x != y) & (change != 0)
    x, y, change = x[used], y[used], change[used]
    return pa.table(
        [pa.array([lang] * len(x), pa.string()), names.take(pa.array(x)), names.take(pa.array(y)), pa.array(change)],
        schema=_PAIRS,
    )


_PAIRS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("change", pa.int64())]
)


def _pair_changes(entries: DataFrame, stats: DataFrame, limits: Limits) -> DataFrame:
    """(lang, source, item, change): corrections summed over all blocks of terms."""
    tiles_of = F.ceil(F.col("n_sources") / limits.tile).cast("int")
    blocks_of = F.ceil(F.col("v") / limits.block).cast("int")

    def paired(df: DataFrame) -> DataFrame:
        """Each row once per tile that its own is compared with."""
        tiled = df.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("n_tiles")).cast("int"))
        each = tiled.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)))
        return each.withColumns({"a": F.least("tile", "_other"), "b": F.greatest("tile", "_other")})

    counted = stats.withColumns({"n_tiles": tiles_of, "n_blocks": blocks_of}).where("v > 0")
    sized = counted.select("lang", "source", "n_tiles", "n_blocks")
    block = F.pmod(F.xxhash64("term"), F.col("n_blocks")).cast("int").alias("block")
    rows = paired(entries.join(sized, ["lang", "source"])).select("lang", "a", "b", block, "term", "source", "p")
    every = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block")
    tiles = paired(counted).select("lang", "a", "b", every, "source", "zero", "tile")
    key = ["lang", "a", "b", "block"]
    changes = rows.groupBy(*key).cogroup(tiles.groupBy(*key)).applyInArrow(
        _pair_block, "lang string, source string, item string, change bigint"
    )
    return changes.groupBy("lang", "source", "item").agg(F.sum("change").alias("change"))


def divergence(
    docs: DataFrame, least_docs: int = 30, top_terms: int = 50,
    text: str = "text", lang: str = "lang", source: str = "source", limits: Limits = Limits(),
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every source of every language.

    Part ``pair`` compares the smoothed shares of all kept terms with those of each other source of
    the language; the result has a row for each, however many. Part ``term`` gives the terms that the
    source uses most beyond its language's share. Ranks go by value, descending, then item. Nulls
    are empty strings, repeated rows count each, an empty table gives no rows, and columns besides
    the three named ones play no part.
    """
    kept = staged(frequencies(docs, least_docs, text, lang, source, limits=limits))
    named = [F.coalesce(F.col(quoted(c)), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]
    groups = docs.select(*named).groupBy("lang", "source").agg(F.lit(1).alias("_one")).drop("_one")
    used = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    totals = used.groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    counted = staged(groups.join(totals, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    ))
    langs = counted.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count(F.lit(1)).alias("n_sources"))
    langs = staged(langs.join(sizes, "lang", "left").select(
        "lang", "lang_n", "n_sources", F.coalesce("v", F.lit(0).cast("long")).alias("v")
    ))
    zero = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("n"), F.col("v")))
    stats = staged(counted.join(langs, "lang").withColumn("zero", zero))

    whole = F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("whole")
    flat = kept.select("lang", "term", whole, F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    flat = flat.select("lang", "term", "whole", F.col("e.sources").alias("source"), F.col("e.counts").alias("count"))
    entries = staged(flat.join(stats, ["lang", "source"]).select(
        "lang", "term", "source",
        share(F.col("count"), F.col("n"), F.col("v")).alias("p"),
        share(F.col("whole"), F.col("lang_n"), F.col("v")).alias("q"),
    ))

    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    other = stats.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"))
    base = F.coalesce(F.col("v") * F.abs(F.col("zero") - F.col("other_zero")), F.lit(0).cast("long"))
    pairs = (
        stats.join(other, "lang").where("source <> item")
        .join(_pair_changes(entries, stats, limits), ["lang", "source", "item"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item",
                (base + F.coalesce("change", F.lit(0).cast("long"))).alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
    )
    terms = (
        entries.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= top_terms)
    )
    return pairs.unionByName(terms)
