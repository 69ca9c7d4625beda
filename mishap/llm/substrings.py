"""Removal of repeated passages, by suffix trees over words that are partitioned by prefix.

The suffixes of all texts, cut at ``window`` words, form one tree; an inner node at that depth is a
passage that repeats. The tree is never built in one place:

* Every window of a text is filed under one sampled suffix start in it, the place of the least hash
  of the ``PREFIX`` words that follow. Equal windows choose the same place, so the prefixes at the
  sampled starts are a sparse first level of the tree, some 6 % of all suffixes.
* A prefix that one document alone holds has no inner node below it and is pruned. Counting is an
  aggregation that tasks combine before the shuffle, so a prefix in a third of all rows is cheap.
* Suffixes below the remaining prefixes are dealt to groups by prefix. The prefix is as long as
  needed: where ``PREFIX`` words are shared by more than ``HEAVY`` documents, the whole window is
  the prefix, so that one passage cannot fill a group.
* A group sorts its suffixes and walks the runs of equal ones, which are the subtree's nodes at
  depth ``window``; each yields the least document and the places that repeat it.

Words are compared by 64-bit digests and windows by 64-bit hashes of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mishap.llm.common import buckets, field, map_batches, quoted, staged
from mishap.llm.rolling import DIGESTS, least_places, runs

PREFIX = 16
HEAVY = 1_000
SUFFIXES_PER_GROUP = 400_000
SUFFIXES_PER_START = 20
WORDS_AT_ONCE = 4_000_000


def _prefixes(text: bytes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every window, and the place and hash of the prefix that each is filed under."""
    digests = DIGESTS.array(text.split())
    prefixes = runs(digests, min(PREFIX, window))
    whole = runs(digests, window)
    places = least_places(prefixes, window - min(PREFIX, window) + 1)
    return whole, places, prefixes[places] if len(places) else prefixes[:0]


def _sample(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[dict]:
    for batch in batches:
        found = [
            np.unique(_prefixes(text or b"", window)[2]).view(np.int64)
            for text in batch.column("text").to_pylist()
        ]
        yield {
            "doc_id": batch.column("doc_id"),
            "th": batch.column("th"),
            "prefixes": _lists(found, np.int64),
        }


def _lists(parts: list[np.ndarray], dtype) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate(parts) if parts else np.zeros(0, dtype)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(dtype)))


def _batch_suffixes(rows: list[tuple], window: int, groups: int) -> dict:
    """Suffixes of some texts by group, one row per group, and what these texts decide themselves.

    Within the batch only a window's least document need ask the others; the rest repeat it.
    """
    hashes, numbers, places, owners, heavy_flags = [], [], [], [], []
    for number, (_, _, text, prefixes, heavy) in enumerate(rows):
        whole, _, owner = _prefixes(text or b"", window)
        order = np.argsort(prefixes)
        at = np.searchsorted(prefixes, owner.view(np.int64), sorter=order)
        at[at == len(prefixes)] = 0
        at = order[at]
        kept = np.flatnonzero(prefixes[at] == owner.view(np.int64))
        hashes.append(whole[kept])
        owners.append(owner[kept])
        heavy_flags.append(heavy[at[kept]])
        places.append(kept)
        numbers.append(np.full(len(kept), number))
    hashes, numbers, places, owners, flags = map(
        np.concatenate, (hashes, numbers, places, owners, heavy_flags)
    )
    docs = np.array([row[0] for row in rows], np.int64)
    keys = np.array([row[1] for row in rows], np.int64)
    order = np.lexsort((docs[numbers], hashes))
    head = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]) if len(order) else order
    least = docs[numbers[order]]
    if len(order):
        least = least[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    repeats = np.empty(len(order), bool)
    repeats[order] = docs[numbers[order]] > least
    group = (np.where(flags, hashes, owners) % np.uint64(groups)).astype(np.int64)
    group[repeats] = numbers[repeats] % groups
    order = np.lexsort((places, numbers, repeats, group))
    hashes, numbers, places, repeats, group = (
        x[order] for x in (hashes, numbers, places, repeats, group)
    )
    # Consecutive places of a text in a group travel as one run.
    if len(order):
        new = np.concatenate(
            [
                [True],
                (np.diff(group) != 0)
                | (np.diff(numbers) != 0)
                | (np.diff(places) != 1)
                | (repeats[1:] != repeats[:-1]),
            ]
        )
        heads = np.flatnonzero(new)
    else:
        heads = np.zeros(0, np.int64)
    lengths = np.diff(np.append(heads, len(order)))
    asking = ~repeats
    chosen, run_starts = np.unique(group[heads], return_index=True)
    run_bounds = np.append(run_starts, len(heads))
    by_run = np.split(heads, run_bounds[1:-1]) if len(chosen) else []
    ends = np.append(heads, len(order))[run_bounds]
    return {
        "part": chosen,
        "doc": _lists([docs[numbers[h]] for h in by_run], np.int64),
        "th": _lists([keys[numbers[h]] for h in by_run], np.int64),
        "start": _lists([places[h] for h in by_run], np.int64),
        "length": _lists(
            [lengths[a:b] for a, b in zip(run_bounds, run_bounds[1:])] if len(chosen) else [],
            np.int64,
        ),
        "decided": _lists([repeats[h].astype(np.int8) for h in by_run], np.int8),
        "hashes": _lists(
            [hashes[a:b][asking[a:b]].view(np.int64) for a, b in zip(ends, ends[1:])]
            if len(chosen)
            else [],
            np.int64,
        ),
    }


def _suffixes(batches: Iterator[pa.RecordBatch], window: int, groups: int) -> Iterator[dict]:
    rows, size = [], 0
    for batch in batches:
        columns = [batch.column(c) for c in ("doc_id", "th", "text", "prefixes", "heavy")]
        for i in range(batch.num_rows):
            prefixes = columns[3][i].values.to_numpy()
            heavy = columns[4][i].values.to_numpy(zero_copy_only=False)
            text = columns[2][i].as_py()
            rows.append((columns[0][i].as_py(), columns[1][i].as_py(), text, prefixes, heavy))
            size += len(text) // 6
            if size > WORDS_AT_ONCE:
                yield _batch_suffixes(rows, window, groups)
                rows, size = [], 0
    if rows:
        yield _batch_suffixes(rows, window, groups)


def _subtree(table: pa.Table, window: int) -> pa.Table:
    """Passages of one group that stand in an earlier document, as word spans per document."""
    columns = {c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
               for c in ("doc", "th", "start", "length", "decided", "hashes")}
    docs, starts, lengths = columns["doc"], columns["start"], columns["length"]
    decided = columns["decided"].astype(bool)
    spans = [(docs[decided], columns["th"][decided], starts[decided], lengths[decided])]
    runs_ = np.flatnonzero(~decided)
    number = np.repeat(runs_, lengths[runs_])
    first = np.repeat(np.cumsum(lengths[runs_]) - lengths[runs_], lengths[runs_])
    place = starts[number] + np.arange(len(number)) - first
    order = np.lexsort((docs[number], columns["hashes"]))
    hashes, owner = columns["hashes"][order], docs[number[order]]
    if len(order):
        head = np.concatenate([[True], hashes[1:] != hashes[:-1]])
        least = owner[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
        again = order[owner > least]
        spans.append((docs[number[again]], columns["th"][number[again]], place[again],
                      np.ones(len(again), np.int64)))
    doc, th, start, length = (np.concatenate(part) for part in zip(*spans))
    order = np.lexsort((start, th, doc))
    doc, th, start, end = doc[order], th[order], start[order], (start + length)[order]
    if len(order):
        apart = (np.diff(doc) != 0) | (np.diff(th) != 0) | (start[1:] > end[:-1])
        heads = np.flatnonzero(np.concatenate([[True], apart]))
        doc, th, start, end = doc[heads], th[heads], start[heads], np.maximum.reduceat(end, heads)
    return pa.table({"doc_id": doc, "th": th, "start": start, "end": end + window - 1})


def _key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_spans(
    docs: DataFrame, window: int = 50, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Word spans (doc_id, th, start, end) of windows that also start in a smaller document.

    ``th`` is a hash of the text, so that rows which share an id stay apart. Spans of a row may
    touch or overlap. Windows that repeat only within one document are not reported.
    """
    rows = docs.select(
        F.col(quoted(row_id)).cast("long").alias("doc_id"),
        _key(F.col(quoted(text))).alias("th"),
        F.col(quoted(text)).cast("binary").alias("text"),
    ).where("doc_id is not null and text is not null")
    schema = "doc_id long, th long, prefixes array<long>"
    sampled = staged(map_batches(rows, _sample, schema, window))
    single = sampled.select("doc_id", "th", F.explode("prefixes").alias("prefix"))
    shared = (
        single.groupBy("prefix")
        .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count(F.lit(1)).alias("n"))
        .where("a < b")
        .select("prefix", (F.col("n") > HEAVY).alias("heavy"))
    )
    marked = single.join(shared, "prefix").groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("prefix", "heavy")).alias("found")
    )
    marked = staged(
        marked.select("doc_id", "th", F.col("found.prefix").alias("prefixes"), F.col("found.heavy").alias("heavy"))
    )
    total = marked.agg(F.sum(F.size("prefixes"))).first()[0] or 0
    groups = max(16, buckets(total * SUFFIXES_PER_START, SUFFIXES_PER_GROUP))
    schema = (
        "part long, doc array<long>, th array<long>, start array<long>, length array<long>, "
        "decided array<tinyint>, hashes array<long>"
    )
    joined = rows.join(marked, ["doc_id", "th"])
    suffixes = map_batches(joined, _suffixes, schema, window, groups)
    return suffixes.groupBy("part").applyInArrow(
        lambda table: _subtree(table, window), "doc_id long, th long, start long, end long"
    )


def _remove(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict]:
    for batch in batches:
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept": []}
        columns = zip(batch.column("_text").to_pylist(), batch.column("_spans"))
        for text, spans in columns:
            words = (text or b"").split()
            gone = 0
            if spans.is_valid and len(spans):
                mask = np.zeros(len(words) + 1, np.int32)
                np.add.at(mask, spans.values.field("start").to_numpy(), 1)
                np.add.at(mask, spans.values.field("end").to_numpy(), -1)
                kept = (np.cumsum(mask)[:-1] == 0).tolist()
                left = [word for word, keep in zip(words, kept) if keep]
                gone = len(words) - len(left)
            else:
                left = words
            out["n_words"].append(len(words))
            out["n_removed"].append(gone)
            out["kept"].append(b" ".join(left))
        yield {name: batch.column(name) for name in names} | out


def remove_repeats(
    docs: DataFrame, window: int = 50, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All rows and columns, with n_words, n_removed and the kept words joined by spaces (binary).

    A word goes if it lies in a window of ``window`` words whose words also start somewhere in a
    document with a smaller id; windows are judged on the input. Words are what ASCII white space
    separates. A null text has no words; a text shorter than the window keeps all. Of equal texts
    the one with the least id keeps its words, rows that share an id do not affect each other. Input
    columns named n_words, n_removed or kept are replaced. A row without id keeps all words.
    """
    spans = repeated_spans(docs, window, row_id, text)
    per_row = spans.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(
        F.collect_list(F.struct("start", "end")).alias("_spans")
    )
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept")]
    rows = docs.select(
        *map(quoted, names),
        F.col(quoted(row_id)).cast("long").alias("_id"),
        _key(F.col(quoted(text))).alias("_th"),
        F.col(quoted(text)).cast("binary").alias("_text"),
    )
    rows = rows.join(per_row, ["_id", "_th"], "left").select(*map(quoted, names), "_text", "_spans")
    schema = ", ".join(field(docs, c) for c in names)
    return map_batches(
        rows, _remove, f"{schema}, n_words long, n_removed long, kept binary", names
    )


def digest(removed: DataFrame, row_id: str = "doc_id") -> DataFrame:
    return removed.select(
        F.col(quoted(row_id)).alias(row_id),
        "n_words",
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )
