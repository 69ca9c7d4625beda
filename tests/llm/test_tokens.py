import hashlib
import random
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers as public
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mishap.llm import bpe, byte_bpe, common, packing, token_counts

RANKS = public.path("byte_bpe_50k.tiktoken")
MODEL = public.path("piece_bpe_32k.model")
WORDS = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as file:
        return bpe.read_ranks(file.read())


@pytest.fixture(scope="module")
def tik(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_bitmap():
    bitmap = bpe.RankBitmap(50_000)
    assert bitmap.least() == -1
    for rank in (49_999, 64, 3, 4096):
        bitmap.add(rank)
    found = []
    while (least := bitmap.least()) >= 0:
        found.append(least)
        bitmap.discard(least)
    assert found == [3, 64, 4096, 49_999]


def test_rank_queue_agrees_with_the_library_on_single_pieces(ranks, tik):
    random.seed(5)
    pieces = ["".join(random.choices("ab", k=random.randint(1, 200))) for _ in range(100)]
    pieces += ["".join(random.choices("abcdefgnorst", k=random.randint(1, 900))) for _ in range(60)]
    pieces += ["a" * k for k in (1, 2, 3, 50, 5000)] + ["ab" * 3000, "-" * 20_001, "é中\U0001f600" * 99]
    data = [piece.encode() for piece in pieces]
    ids, counts = bpe.BytePairs.from_ranks(ranks).encode(data)
    ends = np.cumsum(counts)
    for piece, end, n in zip(data, ends, counts):
        assert ids[end - n : end].tolist() == tik._core_bpe.encode_single_piece(piece)
    decoded, lengths = bpe.TokenBytes(ranks).decode(ids)
    assert decoded.tobytes() == b"".join(data) and lengths.sum() == len(decoded)


def test_slices_lose_only_the_space_between(monkeypatch):
    text = b"one two  three\nfour five six seven " * 50
    parts = list(common.slices(text, 40))
    assert len(parts) > 5 and b" ".join(parts) == text


@pytest.mark.parametrize("size", [common.SLICE, 64])
def test_token_counts(docs, texts, monkeypatch, size):
    monkeypatch.setattr(common.slices, "__defaults__", (size,))
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = token_counts.token_counts(docs, MODEL, limit=500).collect()
    want = sorted((i, len(t.encode()), len(model.encode(t))) for i, t in texts)
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in found) == want
    assert all(r.over_limit == (r.n_tokens > 500) for r in found)


@pytest.mark.parametrize("size", [common.SLICE, 64])
def test_byte_bpe_round_trip(docs, texts, tik, monkeypatch, size):
    monkeypatch.setattr(common.slices, "__defaults__", (size,))
    encoded = byte_bpe.encode(docs, RANKS, public.PATTERN)
    found = byte_bpe.digests(byte_bpe.decode(encoded, RANKS)).collect()
    want = []
    for i, t in texts:
        ids = tik.encode_ordinary(t)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), digest, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, found)) == sorted(want)
    at_once = byte_bpe.digests(byte_bpe.round_trip(docs, RANKS, public.PATTERN))
    assert sorted(map(tuple, at_once.collect())) == sorted(want)


def test_packing(docs, texts):
    library = Tokenizer.from_file(WORDS)
    pieces = packing.pack(packing.tokenise(docs, WORDS), 256).withColumn("crc", F.crc32("ids"))
    rows = pieces.collect()
    want = sorted(
        np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes()
        for _, t in texts
    )
    at = {}
    for row in rows:
        assert row.crc == zlib.crc32(row.ids) and len(row.ids) == 4 * row.length
        at.setdefault((row.sequence_id, row.offset), row)
    assert len(at) == len(rows)
    place, built, current = 0, [], b""
    for (sequence, offset), row in sorted(at.items()):
        assert sequence * 256 + offset == place and offset + row.length <= 256
        place += row.length
        assert row.start == len(current) // 4
        current += row.ids
        if len(current) == 4 * row.doc_tokens:
            built.append(current)
            current = b""
    assert sorted(built) == want
    whole = packing.sequences(pieces).orderBy("sequence_id").collect()
    assert all(len(row.ids) == 1024 for row in whole[:-1])
    assert sum(len(row.ids) for row in whole) == sum(map(len, want))


def test_odd_tables(odd, none):
    assert token_counts.token_counts(odd, MODEL).count() == odd.count()
    assert byte_bpe.encode(odd, RANKS, public.PATTERN).count() == odd.count()
    assert token_counts.token_counts(none, MODEL).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(none, RANKS, public.PATTERN), RANKS).count() == 0
    assert packing.pack(packing.tokenise(none, WORDS)).count() == 0


def test_packing_goes_through_every_word_once(odd, monkeypatch):
    """Words are split once, whatever is new of them, and generations of the cache give the library's ids."""
    with open(WORDS, "rb") as file:
        source = file.read()
    rows = [(row.doc_id, (row.text or "").encode()) for row in odd.collect()]
    rows += [(2000 + i, f"word{i % 40} of{i % 7} end".encode()) for i in range(200)]
    batches = [pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in rows[a : a + 25]]) for a in range(0, len(rows), 25)]
    split = packing._words
    calls = []
    monkeypatch.setattr(packing, "_words", lambda text: calls.append(text) or split(text))
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    monkeypatch.setattr(packing, "WORDS_AT_ONCE", 16, raising=False)
    monkeypatch.setattr(packing, "ROWS_AT_ONCE", 10)
    monkeypatch.setattr(common, "_ACTIVE", {})
    if hasattr(packing, "Codes"):
        monkeypatch.setattr(packing.Codes.__init__, "__defaults__", (None, 20))
    found = list(packing._tokenise(iter(batches), SimpleNamespace(value=("small", source)), 2))
    assert len(calls) == len(rows)
    library, before = Tokenizer.from_file(WORDS), 0
    ids = [i for out in found for i in out["ids"]]
    places = [place for out in found for place in out["before"]]
    for (_, text), data, place in zip(rows, ids, places, strict=True):
        expected = library.encode(text.decode(), add_special_tokens=False).ids + [2]
        assert np.frombuffer(data, "<u2").tolist() == expected and place == before
        before += len(expected)
