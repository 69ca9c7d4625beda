"""Byte-level BPE: texts to token ids and back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap.llm.bpe import BytePairs, TokenBytes, read_ranks
from mishap.llm.common import UnitCache, field, map_batches, quoted, slices, texts, worker_cache

# White space next to white space, or white space beyond ASCII.
_UNEVEN = re.compile(
    rb"[\s\x1c-\x1f]{2}|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
# Rows whose ids are put together at a time.
ROWS_AT_ONCE = 500
_DECODERS: dict[str, TokenBytes] = {}


def _units(part: bytes, pattern: regex.Pattern, first: bool) -> list[bytes]:
    """Parts of a text that are split and encoded independently.

    With single spaces only, a part is what stands between two of them and is meant with the space
    before it; otherwise every match of the pattern is a part. A part that starts with a space is
    meant as what follows that space.
    """
    if _UNEVEN.search(part):
        text = part.decode() if first else " " + part.decode()
        return [b" " + match.encode() for match in pattern.findall(text)]
    units = part.split(b" ")
    if first:
        units[0] = b" " + units[0]
    return units


def _text_units(text: bytes, pattern: regex.Pattern) -> Iterator[list[bytes]]:
    for number, part in enumerate(slices(text)):
        yield _units(part, pattern, number == 0)


class _Encoder:
    """Ids of parts as int32 bytes: split by the pattern, then merged all together."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.pairs = BytePairs.from_ranks(ranks)
        self.tokens = UnitCache(self._merge, limit=200_000)

    def _merge(self, tokens: list[bytes]) -> list[bytes]:
        """Ids of single pre-tokens; one that is a token itself is taken as it is."""
        unknown = [token for token in tokens if token not in self.ranks]
        ids, counts = self.pairs.encode(unknown)
        data, ends = ids.astype(np.int32).tobytes(), (np.cumsum(counts) * 4).tolist()
        merged = dict(zip(unknown, map(data.__getitem__, map(slice, [0, *ends], ends))))
        return [
            merged[token] if token in merged else np.int32(self.ranks[token]).tobytes()
            for token in tokens
        ]

    def __call__(self, parts: list[bytes]) -> list[bytes]:
        find = self.pattern.findall
        split = [
            [m.encode() for m in find((p[1:] if p[:1] == b" " else b" " + p).decode())] for p in parts
        ]
        self.tokens.prepare(split)
        known = self.tokens.found.__getitem__
        return [b"".join(map(known, tokens)) for tokens in split]


def _encode(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[dict]:
    key, data, source = shared.value
    cache = worker_cache(
        ("byte BPE", key), lambda: UnitCache(_Encoder(read_ranks(data), source), limit=200_000)
    )
    pattern = regex.compile(source)
    for batch in batches:
        rows = [text or b"" for text in batch.column("text").to_pylist()]
        cache.prepare(units for text in rows for units in _text_units(text, pattern))
        ids_of = cache.found.__getitem__
        for start in range(0, len(rows), ROWS_AT_ONCE):
            encoded = [
                b"".join([b"".join(map(ids_of, units)) for units in _text_units(text, pattern)])
                for text in rows[start : start + ROWS_AT_ONCE]
            ]
            offsets = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in encoded])])
            values = np.frombuffer(b"".join(encoded), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
            yield {"doc_id": batch.column("doc_id").slice(start, ROWS_AT_ONCE), "ids": ids}


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Token ids of every text as (id, ids array<int>), without special tokens.

    Each match of the pattern is encoded on its own. Parts of text that a worker has met before come
    from its bounded cache; all others of a batch are merged in one run of the rank queue. Nothing is
    shuffled. A null text counts as empty and has no ids; other columns are not read. The rank file
    is read on the driver and broadcast (its size is that of the vocabulary).
    """
    with open(ranks_path, "rb") as file:
        data = file.read()
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((key, data, pattern))
    rows = texts(docs, row_id, text)
    encoded = map_batches(rows, _encode, f"{field(rows, 'doc_id')}, ids array<int>", shared)
    return encoded.select(F.col("doc_id").alias(row_id), "ids")


def _round_trip(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[dict]:
    table = TokenBytes(read_ranks(shared.value[1]))
    for columns in _encode(batches, shared):
        yield columns | {"decoded": _decoded(columns["ids"], table)}


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``decode`` of ``encode`` in one pass, where one Python worker does both: (id, ids, decoded)."""
    with open(ranks_path, "rb") as file:
        data = file.read()
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((key, data, pattern))
    rows = texts(docs, row_id, text)
    schema = f"{field(rows, 'doc_id')}, ids array<int>, decoded binary"
    found = map_batches(rows, _round_trip, schema, shared)
    return found.select(F.col("doc_id").alias(row_id), "ids", "decoded")


def _decoded(column: pa.ListArray, table: TokenBytes) -> list[bytes]:
    """The bytes that each row's ids stand for."""
    ends = np.cumsum([0, *[n or 0 for n in pa.compute.list_value_length(column).to_pylist()]])
    decoded, lengths = table.decode(column.flatten().to_numpy(zero_copy_only=False))
    places = np.concatenate([[0], np.cumsum(lengths)])[ends].tolist()
    whole = decoded.tobytes()
    return [whole[a:b] for a, b in zip(places, places[1:])]


def _decode(batches: Iterator[pa.RecordBatch], shared: Broadcast, names: list[str]) -> Iterator[dict]:
    key, data = shared.value
    if key not in _DECODERS:
        _DECODERS.clear()
        _DECODERS[key] = TokenBytes(read_ranks(data))
    table = _DECODERS[key]
    parts = (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE))
    for batch in parts:
        found = _decoded(batch.column("ids"), table)
        yield {name: batch.column(name) for name in names} | {"decoded": found}


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Add ``decoded``, the bytes that the token ids in ``ids`` stand for; null ids give no bytes."""
    with open(ranks_path, "rb") as file:
        data = file.read()
    shared = encoded.sparkSession.sparkContext.broadcast((hashlib.sha256(data).hexdigest(), data))
    names = [c for c in encoded.columns if c != "decoded"]
    schema = ", ".join([field(encoded, c) for c in names] + ["decoded binary"])
    return map_batches(encoded.select(*map(quoted, names)), _decode, schema, shared, names)


def digests(decoded: DataFrame, row_id: str = "doc_id") -> DataFrame:
    """Per row: number of ids, and SHA-256 of the ids (decimal, joined by spaces) and of the bytes."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        F.col(quoted(row_id)).alias(row_id),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
