"""Token counts of texts by a subword model, from tables of pre-token lengths."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap.llm.common import UnitCache, field, map_batches, slices, texts, worker_cache

TABLE_ENTRIES = 32_768
SUMMARY_ENTRIES = 4_096
COUNTER_ENTRIES = 200_000
SPACE = "▁"
_RUN = re.compile(rb" +[^ ]*")


def pretokens(text: bytes) -> list[bytes]:
    """Pre-tokens of a text: runs of spaces with what follows them, each without its first space.

    The model puts one space before the text, and a space sign counts as a space.
    """
    if b"\xe2\x96\x81" in text:
        text = text.replace(b"\xe2\x96\x81", b" ")
    if b"  " in text or text[:1] == b" " or text[-1:] == b" ":
        return [unit[1:] for unit in _RUN.findall(b" " + text)]
    return text.split(b" ")


def _splits_at_spaces(model: sentencepiece.SentencePieceProcessor) -> bool:
    """No piece has a space behind another character, so pre-tokens are encoded independently."""
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    plain = model.normalize("ﬁ Ａ  x ") if hasattr(model, "normalize") else None
    spaced = "▁ﬁ▁Ａ▁▁x▁"
    return plain in (None, spaced) and not any(SPACE in p.lstrip(SPACE) for p in pieces)


def _lengths(model: sentencepiece.SentencePieceProcessor, parts: list[bytes]) -> list[int]:
    encoded = model.encode([part.decode() for part in parts], num_threads=1)
    return [len(ids) if part else 1 for part, ids in zip(parts, encoded)]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The most frequent pre-tokens of a partition: a counter that drops its rarest half when full."""
    counts: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            for part in slices(text or b""):
                counts.update(pretokens(part) if part else ())
            if len(counts) > COUNTER_ENTRIES:
                counts = Counter(dict(counts.most_common(COUNTER_ENTRIES // 2)))
    top = counts.most_common(SUMMARY_ENTRIES)
    yield {"unit": [unit for unit, _ in top], "n": [n for _, n in top]}


def frequent_pretokens(docs: DataFrame, entries: int = TABLE_ENTRIES) -> list[bytes]:
    """The most frequent pre-tokens over all texts, from one bounded summary per task."""
    summaries = map_batches(docs, _summaries, "unit binary, n long")
    totals = summaries.groupBy("unit").agg(F.sum("n").alias("n"))
    rows = totals.orderBy(F.desc("n"), "unit").limit(entries).collect()
    return [bytes(row["unit"]) for row in rows]


def _cache(shared: Broadcast) -> UnitCache:
    key, proto, words, lengths = shared.value

    def make() -> UnitCache:
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        table = dict(zip(words.split(b" "), lengths.tolist())) if len(lengths) else {}
        return UnitCache(lambda parts: _lengths(model, parts), table)

    return worker_cache(("token counts", key), make)


def _count(batches: Iterator[pa.RecordBatch], shared: Broadcast, splits: bool) -> Iterator[dict]:
    cache = _cache(shared)
    if not splits:
        model = sentencepiece.SentencePieceProcessor(model_proto=shared.value[1])
    for batch in batches:
        rows = [text or b"" for text in batch.column("text").to_pylist()]
        if splits:
            cache.prepare(pretokens(part) for text in rows if text for part in slices(text))
            length = cache.found.__getitem__
            counts = [
                sum(sum(map(length, pretokens(part))) for part in slices(text)) if text else 0
                for text in rows
            ]
        else:
            counts = [len(model.encode(text.decode())) for text in rows]
        yield {
            "doc_id": batch.column("doc_id"),
            "n_bytes": [len(text) for text in rows],
            "n_tokens": counts,
        }


def token_counts(
    docs: DataFrame,
    model_path: str,
    row_id: str = "doc_id",
    text: str = "text",
    limit: int = 4096,
    entries: int = TABLE_ENTRIES,
) -> DataFrame:
    """Per row: id, n_bytes, n_tokens and whether the text has more than ``limit`` tokens.

    A first pass finds the most frequent pre-tokens (a bounded summary per task, none is shuffled
    beyond those). Their token counts are broadcast as one table of at most ``entries``; everything
    else is encoded once per worker and kept in a bounded cache. The model file is read on the
    driver. A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted each; other
    columns of the input are not read. Models whose pieces cross spaces are applied to whole texts.
    """
    with open(model_path, "rb") as file:
        proto = file.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=proto)
    rows = texts(docs, row_id, text)
    splits = _splits_at_spaces(model)
    # A pre-token that holds a space cannot stand in the space-separated table.
    words = [w for w in frequent_pretokens(rows, entries) if w and b" " not in w] if splits else []
    lengths = np.array(_lengths(model, words), np.int32) if words else np.zeros(0, np.int32)
    joined = b" ".join(words)
    key = hashlib.sha256(proto + joined).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((key, proto, joined, lengths))
    schema = f"{field(rows, 'doc_id')}, n_bytes long, n_tokens long"
    counted = map_batches(rows, _count, schema, shared, splits)
    return counted.select(
        F.col("doc_id").alias(row_id),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
