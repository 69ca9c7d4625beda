"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text."""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap.llm.common import UnitCache, field, held, map_batches, quoted, slices, staged, texts, worker_cache

PUNCTUATION = b".,!?;:\"'()[]"
# A window is a word with its mirror image, which doubles what a match saves, behind blanks: they
# give the coder something to save, without which it stores short input as it is.
BLANKS = b" " * 32
LEVEL = 13


@dataclass(frozen=True)
class Params:
    """Bounds of what the dictionaries are learned from, and when a word is typical of toxic text."""

    documents_per_class: int = 4_000
    ordinary_bytes: int = 49_152
    toxic_bytes: int = 16_384
    least_count: int = 8
    least_share: float = 0.002
    least_ratio: float = 8.0
    least_deviation: float = 6.0


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and the toxic share of texts by their largest length difference."""

    toxic: bytes
    ordinary: bytes
    steps: tuple[int, ...]
    shares: tuple[float, ...]

    def score(self, gain: int) -> float:
        return self.shares[bisect.bisect_right(self.steps, gain) - 1]


def mirrored(word: bytes) -> bytes:
    """The mirror image comes first, so that words that share a beginning share one middle part."""
    return word[::-1] + b" " + word + b" "


# Rows whose texts and new words a task holds at a time.
ROWS_AT_ONCE = 1_000


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


class _Gain:
    """By how many bytes the toxic dictionary compresses a window better than the ordinary one."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.compressors = [self._compressor(content) for content in (ordinary, toxic)]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            min_match=3,
            window_log=17,
            hash_log=14,
            chain_log=15,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        if not content:
            return zstandard.ZstdCompressor(compression_params=params)
        dictionary = zstandard.ZstdCompressionDict(
            content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        dictionary.precompute_compress(compression_params=params)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params)

    def __call__(self, words: list[bytes]) -> list[int]:
        ordinary, toxic = (c.compress for c in self.compressors)
        found: dict[bytes, int] = {}
        gains = []
        for word in words:
            core = word.strip(PUNCTUATION)
            if core not in found:
                window = BLANKS + mirrored(core)
                found[core] = len(ordinary(window)) - len(toxic(window)) if core else 0
            gains.append(found[core])
        return gains


def _cache(shared: Broadcast) -> UnitCache:
    key, toxic, ordinary = shared.value
    return worker_cache(("toxicity", key), lambda: UnitCache(_Gain(toxic, ordinary), limit=300_000))


def _gains(
    batches: Iterator[pa.RecordBatch], shared: Broadcast, names: list[str]
) -> Iterator[dict]:
    cache = _cache(shared)
    for batch in (whole.slice(i, ROWS_AT_ONCE) for whole in batches for i in range(0, whole.num_rows, ROWS_AT_ONCE)):
        rows = [text or b"" for text in batch.column("_text").to_pylist()]
        cache.prepare(_words(part) for text in rows for part in slices(text))
        gain = cache.found.__getitem__
        best = [
            max(
                (max(map(gain, words)) for part in slices(text) if (words := _words(part))),
                default=0,
            )
            for text in rows
        ]
        yield {name: batch.column(name) for name in names} | {"_gain": [max(0, g) for g in best]}


def _contexts(batches: Iterator[pa.RecordBatch], toxic: set[int]) -> Iterator[dict]:
    """Words with their neighbours, once per batch and class: copies of a text say nothing new."""
    for batch in batches:
        seen: set[tuple] = set()
        for number, text in zip(batch.column("number").to_pylist(), batch.column("text").to_pylist()):
            label = number in toxic
            for part in slices(text or b""):
                words = [w for w in (w.strip(PUNCTUATION) for w in _words(part)) if w]
                seen.update((label, *w) for w in zip([b"", *words], words, [*words[1:], b""]))
        columns = list(zip(*seen)) or [[], [], [], []]
        yield dict(zip(("toxic", "before", "word", "after"), map(list, columns)))


def _fit_steps(counts: dict[int, tuple[int, int]]) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """Toxic share by gain, made non-decreasing by pooling neighbours; smoothed by half a text."""
    pools: list[list] = []
    for gain in sorted(counts):
        pools.append([gain, *counts[gain]])
        while len(pools) > 1 and _share(pools[-2]) >= _share(pools[-1]):
            _, t, n = pools.pop()
            pools[-1][1] += t
            pools[-1][2] += n
    steps = (-(1 << 30), *(pool[0] for pool in pools[1:]))
    return steps, tuple(_share(pool) for pool in pools) or (0.0,)


def _share(pool: list) -> float:
    return (pool[1] + 0.5) / (pool[2] + 1)


def held_out(row_id: str) -> F.Column:
    """True for the fifth of rows whose labels are never learned from."""
    return F.crc32(F.col(quoted(row_id)).cast("string").cast("binary")) % 5 == 0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    params: Params = Params(),
) -> Model:
    """The model that ``fit_and_score`` finds."""
    return fit_and_score(docs, labels, [row_id], row_id, text, label, params)[0]


def fit_and_score(
    docs: DataFrame,
    labels: DataFrame,
    columns: Sequence[str],
    row_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    params: Params = Params(),
) -> tuple[Model, DataFrame]:
    """Learn from the labelled rows, and score all: the model, and ``columns`` with ``_score``.

    Texts are gone through once for both: labels meet the gains, not the texts, so no text is
    shuffled beyond those that teach.

    Rows are drawn per class in hash order from those not held out. Three folds of four teach the
    dictionaries: a word is typical of toxic text if it stands in clearly more different contexts
    there than its frequency in ordinary text lets expect. The toxic dictionary is made of such
    words, the ordinary one of the most frequent others. All labelled rows that do not teach
    calibrate, whatever their number, so the class shares are those of the labels: the share of toxic
    texts by the largest gain of a window. Without labels of both classes every score is 0.
    """
    columns = list(dict.fromkeys([*columns, row_id]))
    known = labels.where(F.col(quoted(label)).isin(0, 1) & ~held_out(row_id))
    known = known.groupBy(F.col(quoted(row_id)).alias("id")).agg(F.max(quoted(label)).alias("y"))
    rows = []
    for y in (0, 1):
        order = F.xxhash64("id", F.lit("draw"))
        drawn = known.where(F.col("y") == y).orderBy(order, "id").limit(params.documents_per_class)
        rows += [(r["id"], y) for r in drawn.collect()]
    spark = docs.sparkSession
    id_type = docs.schema[row_id].dataType.simpleString()
    sample = spark.createDataFrame(
        [(i, n, y) for n, (i, y) in enumerate(rows)], f"id {id_type}, number int, y int"
    )
    train = texts(docs, row_id, text).join(F.broadcast(sample), F.col("doc_id") == F.col("id"))
    train = held(train.select("doc_id", "text", "number", "y"))
    toxic = {n for n, (_, y) in enumerate(rows) if y}
    teach = train.where("number % 4 <> 0")
    taught = F.broadcast(sample.where("number % 4 <> 0").select("id"))
    n1 = sum(n % 4 != 0 for n in toxic)
    n0 = sum(n % 4 != 0 for n in range(len(rows))) - n1
    # Too few labels for a dictionary of either class.
    if not n1 or not n0:
        model = Model(b"", b"", (-(1 << 30),), (0.0,))
        return model, with_score(docs, model, text).select(*map(quoted, columns), "_score")

    contexts = map_batches(
        teach.select("number", "text"),
        _contexts,
        "toxic boolean, before binary, word binary, after binary",
        toxic,
    )
    counts = contexts.distinct().groupBy("word").agg(
        F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("o")
    )
    counts = held(counts.where("t + o > 2"))
    expected = F.col("o") * F.lit(n1 / n0)
    typical = counts.where(
        (F.col("t") >= max(params.least_count, math.ceil(params.least_share * n1)))
        & (F.length("word") >= 4)
        & (F.col("t") >= params.least_ratio * (expected + 0.5))
        & (F.col("t") - expected >= params.least_deviation * F.sqrt(expected + 1))
    )
    entries = params.toxic_bytes // 4
    bad = [bytes(r["word"]) for r in typical.orderBy(F.desc("t"), "word").limit(entries).collect()]
    entries = params.ordinary_bytes // 2
    common = counts.orderBy(F.desc("o"), "word").limit(entries).collect()
    good = [word for r in common if (word := bytes(r["word"])) not in set(bad)]
    contents = [_content(bad, params.toxic_bytes), _content(good, params.ordinary_bytes)]

    gains = staged(_with_gain(docs, *contents, text).select(*map(quoted, columns), "_gain"))
    judge = gains.select(F.col(quoted(row_id)).alias("id"), "_gain").join(known.join(taught, "id", "left_anti"), "id")
    table = judge.groupBy("_gain").agg(F.sum("y").alias("t"), F.count("y").alias("n")).collect()
    steps, shares = _fit_steps({r["_gain"]: (r["t"], r["n"]) for r in table})
    model = Model(contents[0], contents[1], steps, shares)
    return model, _scored(gains, model)


def _content(words: list[bytes], size: int) -> bytes:
    """A dictionary of words, the most frequent last, where offsets to them are shortest."""
    chosen, used = [], 0
    for word in words:
        used += len(mirrored(word))
        if used > size:
            break
        chosen.append(word)
    return b"".join(map(mirrored, reversed(chosen)))


def _with_gain(docs: DataFrame, toxic: bytes, ordinary: bytes, text: str) -> DataFrame:
    """Add ``_gain``: the largest gain of the toxic dictionary over the text's windows."""
    names = [c for c in docs.columns if c not in ("_text", "_gain")]
    rows = docs.select(*map(quoted, names), F.col(quoted(text)).cast("binary").alias("_text"))
    key = hashlib.sha256(toxic + b"\0" + ordinary).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((key, toxic, ordinary))
    schema = ", ".join([*(field(docs, c) for c in names), "_gain int"])
    return map_batches(rows, _gains, schema, shared, names)


def with_score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns, with ``_score`` in 0..1.

    Every word of the whole text is a window. Windows that a worker has met before come from its
    bounded cache, nothing is shuffled, and the model is a few tens of kilobytes. Null and empty
    texts have no window and get the score of texts without any gain. Repeated rows are scored each.
    """
    return _scored(_with_gain(docs, model.toxic, model.ordinary, text), model)


def _scored(gains: DataFrame, model: Model) -> DataFrame:
    shares = F.lit(model.shares[0])
    for step, share in zip(model.steps[1:], model.shares[1:]):
        shares = F.when(F.col("_gain") >= step, F.lit(share)).otherwise(shares)
    return gains.withColumn("_score", shares.cast("double")).drop("_gain")


def score(docs: DataFrame, model: Model, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, held_out, score as in ``with_score`` and predicted (score >= 0.5)."""
    rows = docs.select(F.col(quoted(row_id)).alias("id"), F.col(quoted(text)).alias("text"))
    return verdicts(with_score(rows, model).withColumnRenamed("id", row_id), row_id)


def verdicts(scored: DataFrame, row_id: str = "doc_id") -> DataFrame:
    """Per scored row: id, held_out, score and predicted (score >= 0.5)."""
    found = scored.select(
        F.col(quoted(row_id)).alias(row_id),
        F.coalesce(held_out(row_id), F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
    )
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
