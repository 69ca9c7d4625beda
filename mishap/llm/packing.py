"""Packing tokenised texts into sequences of fixed length: concatenate and cut."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping
from itertools import compress, count, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mishap.llm.bpe import BytePairs
from mishap.llm.common import buckets, field, map_batches, slices, staged, texts, worker_cache

# Words whose normalisation is plain lower case: printable ASCII and Latin letters with accents.
_PLAIN = re.compile(r"[\x21-\x7e\xc0-\xff]*")
# How byte-level files of this family split words: the shape of most words is known without it.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Rows and words whose ids are put together at a time.
ROWS_AT_ONCE = 1_000
WORDS_AT_ONCE = 1 << 18
# Text whose new words are merged together.
BYTES_AT_ONCE = 1 << 23


class Table:
    """Ids of numbered parts: part i has ``counts[i]`` ids from ``starts[i]``."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        self.ids, self.counts = ids, counts
        self.starts = np.cumsum(counts) - counts

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the parts, one after the other, and the number of ids of each."""
        counts = self.counts[numbers]
        places = np.repeat(self.starts[numbers] - (np.cumsum(counts) - counts), counts)
        places += np.arange(len(places))
        return self.ids[places], counts

    def followed_by(self, ids: np.ndarray, counts: np.ndarray) -> Table:
        return Table(np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts]))


class Codes:
    """Ids of parts of text that recur, kept by a Python worker across its tasks.

    ``numbers`` gives a part its number when it is first asked for, so one lookup serves known and
    new parts; ``settle`` computes, all at once, the ids of those that are new. A full cache begins
    anew, and goes on with what it is asked for again of the entries so far: half of the words of a
    batch stand in the batch before. Two generations are held, each of at most ``limit`` entries and
    those of one batch. Parts of the seed have the first numbers in each.
    """

    def __init__(
        self,
        compute: Callable[[list], tuple[np.ndarray, np.ndarray]],
        dtype: np.dtype,
        seed: Mapping[bytes, int] | None = None,
        limit: int = 100_000,
    ):
        self.compute, self.limit, self.seed = compute, limit, dict(seed or {})
        ids = np.array(list(self.seed.values()), dtype)
        self.seeded = Table(ids, np.ones(len(ids), np.int64))
        self.numbers: dict = {}
        self.table = self.seeded
        self._begin()

    def _begin(self) -> None:
        self.older, self.older_table = self.numbers, self.table
        self.numbers, self.table = defaultdict(count().__next__), self.seeded
        for part in self.seed:
            self.numbers[part]

    def turn(self) -> None:
        """To be called before each batch."""
        if len(self.numbers) > self.limit:
            self._begin()

    def settle(self) -> None:
        new = list(islice(self.numbers, len(self.table.counts), None))
        if not new:
            return
        before = np.fromiter(map(self.older.get, new, repeat(-1)), np.int64, len(new))
        missing = before < 0
        known = Table(*self.older_table.take(before[~missing]))
        both = known.followed_by(*self.compute(list(compress(new, missing.tolist()))))
        order = np.empty(len(new), np.int64)
        order[~missing] = np.arange(len(known.counts))
        order[missing] = np.arange(len(known.counts), len(new))
        self.table = self.table.followed_by(*both.take(order))


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte value in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


class _WordEncoder:
    """Ids of words without white space, as little-endian unsigned integers, and their numbers.

    Plain words are split by the tokenizer file's own pattern and merged together by its rules; all
    others, and words that may hold a special token, go through the tokenizers library.
    """

    def __init__(self, source: bytes):
        self.library = Tokenizer.from_str(source.decode())
        content = json.loads(source)
        model, vocab = content["model"], content["model"]["vocab"]
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.tokens = Codes(self._merge, self.dtype)
        self.special = [t["content"].encode() for t in content["added_tokens"]]
        steps = [s["type"] for s in (content["normalizer"] or {}).get("normalizers", [])]
        splits = (content["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.rules = None
        if (
            steps == ["NFC", "Replace", "Lowercase"]
            and [s["type"] for s in splits] == ["Split", "ByteLevel"]
            and model["type"] == "BPE"
            and model["end_of_word_suffix"]
            and not model["ignore_merges"]
        ):
            self.pattern = regex.compile(splits[0]["pattern"]["Regex"])
            self.simple = self.pattern.pattern == _PATTERN
            letters, end = _byte_letters(), model["end_of_word_suffix"]
            merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
            self.rules = BytePairs(
                {
                    (vocab[a], vocab[b]): (rank, vocab[a + b])
                    for rank, (a, b) in enumerate(merges)
                },
                [vocab[letters[b]] for b in range(256)],
                [vocab[letters[b] + end] for b in range(256)],
            )

    def _merge(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self.rules.encode([token.encode() for token in tokens])
        return ids.astype(self.dtype), counts

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # Words hold no white space, so all of them are decoded at once.
        joined = b"\n".join(words)
        marks = [mark for mark in {s[:2] for s in self.special} if mark in joined]
        decoded = joined.decode()
        texts, lowered = (decoded.split("\n"), decoded.lower().split("\n")) if words else ([], [])
        plain, others, found = [], [], []
        tokens: list[str] = []
        ends = [0]
        for place, (text, low) in enumerate(zip(texts, lowered)):
            special = marks and any(mark in words[place] for mark in marks)
            if self.rules is None or special or not (text.isascii() or _PLAIN.fullmatch(text)):
                others.append(place)
                found.append(self.library.encode(text, add_special_tokens=False).ids)
                continue
            # Letters with a closing mark need no pattern.
            if not self.simple:
                tokens += self.pattern.findall(low)
            elif low.isalpha():
                tokens.append(low)
            elif (body := low.rstrip(".,;:!?")).isalpha():
                tokens += body, low[len(body) :]
            else:
                tokens += self.pattern.findall(low)
            plain.append(place)
            ends.append(len(tokens))
        # The same token stands in many words, with other punctuation.
        self.tokens.turn()
        numbers = np.fromiter(map(self.tokens.numbers.__getitem__, tokens), np.int64, len(tokens))
        self.tokens.settle()
        ids, counts = self.tokens.table.take(numbers)
        counts = np.diff(np.concatenate([[0], np.cumsum(counts)])[ends])
        if not others:
            return ids, counts
        order = np.empty(len(words), np.int64)
        order[plain] = np.arange(len(plain))
        order[others] = np.arange(len(plain), len(words))
        ids_of_others = np.array([i for ids in found for i in ids], self.dtype)
        return Table(ids, counts).followed_by(ids_of_others, np.array(list(map(len, found)))).take(order)


def _words(text: bytes) -> list[bytes]:
    """ASCII white space separates words; letters of ASCII are lower-cased ahead, to meet more often."""
    return text.split() if b"<|" in text else text.lower().split()


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of about equal row counts, of at most about ``BYTES_AT_ONCE`` of text each."""
    size = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
    rows = -(-batch.num_rows // buckets(size, BYTES_AT_ONCE)) or 1
    return (batch.slice(start, rows) for start in range(0, batch.num_rows, rows))


def _tokenise(batches: Iterator[pa.RecordBatch], shared: Broadcast, end: int) -> Iterator[dict]:
    key, source = shared.value

    def codes_of_words() -> Codes:
        encoder = _WordEncoder(source)
        return Codes(encoder, encoder.dtype, {b"": end})

    # No word is empty, so the empty one stands for the end of a text.
    codes = worker_cache(("words", key, end), codes_of_words)
    width = codes.table.ids.itemsize
    part, before = TaskContext.get().partitionId(), 0
    for batch in (some for whole in batches for some in _parts(whole)):
        codes.turn()
        number, numbers, ends = codes.numbers.__getitem__, array("i"), [0]
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            for text in batch.column("text").slice(start, ROWS_AT_ONCE).to_pylist():
                for piece in slices(text or b""):
                    numbers.extend(map(number, _words(piece)))
                numbers.append(number(b""))
                ends.append(len(numbers))
        codes.settle()
        numbers, ends = np.frombuffer(numbers, np.intc), np.array(ends)
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            bounds = ends[start : start + ROWS_AT_ONCE + 1]
            own = numbers[bounds[0] : bounds[-1]]
            taken = (codes.table.take(own[i : i + WORDS_AT_ONCE])[0] for i in range(0, len(own), WORDS_AT_ONCE))
            ids = b"".join(some.tobytes() for some in taken)
            counts = np.add.reduceat(codes.table.counts[own], bounds[:-1] - bounds[0])
            stops = np.cumsum(counts)
            cuts = (width * stops).tolist()
            yield {
                "doc_id": batch.column("doc_id").slice(start, ROWS_AT_ONCE),
                "part": [part] * len(counts),
                "before": before + stops - counts,
                "n": counts,
                "width": [width] * len(counts),
                "ids": [ids[a:b] for a, b in zip([0, *cuts], cuts)],
            }
            before += int(stops[-1])


def tokenise(
    docs: DataFrame, tokenizer_path: str, end: int = 2, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """First pass: ids of every text and ``end``, with the number of ids before it in its partition."""
    with open(tokenizer_path, "rb") as file:
        source = file.read()
    key = hashlib.sha256(source).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((key, source))
    rows = texts(docs, row_id, text)
    schema = f"{field(rows, 'doc_id')}, part int, before long, n long, width int, ids binary"
    return staged(map_batches(rows, _tokenise, schema, shared, end))


def _cut(batches: Iterator[pa.RecordBatch], base: Mapping[int, int], length: int) -> Iterator[dict]:
    parts = (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE))
    for batch in parts:
        out: dict[str, list] = {name: [] for name in ("start", "length", "sequence_id", "offset", "ids")}
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("part", "before", "n", "width", "ids")]
        for row, (part, before, n, width, ids) in enumerate(zip(*columns)):
            place, start = base[part] + before, 0
            wide = np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
            while start < n:
                sequence, offset = divmod(place + start, length)
                size = min(n - start, length - offset)
                rows.append(row)
                out["start"].append(start)
                out["length"].append(size)
                out["sequence_id"].append(sequence)
                out["offset"].append(offset)
                out["ids"].append(wide[4 * start : 4 * (start + size)])
                start += size
        taken = pa.array(rows, pa.int64())
        yield out | {
            "doc_id": batch.column("doc_id").take(taken),
            "doc_tokens": batch.column("n").take(taken),
        }


def pack(tokens: DataFrame, length: int = 4096, row_id: str = "doc_id") -> DataFrame:
    """Second pass: pieces of the sequences that result from laying all ids end to end.

    The partitions' totals (one number per partition of the first pass) give every partition its
    global offset by prefix sum; each text then knows its place and is cut at the multiples of
    ``length`` without a shuffle. A sequence that spans two partitions consists of the pieces both
    contribute, which carry its id and their offset. Only the last sequence is shorter. A piece has
    (id, start, length, ids as little-endian unsigned 32-bit integers, doc_tokens, sequence_id,
    offset). No rows give no pieces.
    """
    totals = {r["part"]: r["n"] for r in tokens.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    base, total = {}, 0
    for part in sorted(totals):
        base[part] = total
        total += totals[part]
    schema = (
        f"{field(tokens, 'doc_id')}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long"
    )
    pieces = map_batches(tokens, _cut, schema, base, length)
    return pieces.withColumnRenamed("doc_id", row_id)


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences themselves, as (sequence_id, ids): a bounded number of ids per group."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered["ids"], F.lit(b""), lambda a, b: F.concat(a, b))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))
