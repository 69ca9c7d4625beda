"""Helpers shared by the text operators."""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import filterfalse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Texts are worked on in slices of about this many bytes, so that memory doesn't follow their length.
SLICE = 1 << 22
_CUT = re.compile(rb"(?<=[^\x20\x09-\x0D\x1c-\x1f\x80-\xff]) (?=[^\x20\x09-\x0D\x1c-\x1f\x80-\xff])")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def texts(docs: DataFrame, row_id: str, text: str) -> DataFrame:
    """The two columns an operator reads, as (doc_id, text), with the text as UTF-8 bytes or null."""
    return docs.select(
        F.col(quoted(row_id)).alias("doc_id"), F.col(quoted(text)).cast("binary").alias("text")
    )


def field(df: DataFrame, name: str) -> str:
    """The column as a field of a schema string."""
    return f"{quoted(name)} {df.schema[name].dataType.simpleString()}"


def slices(text: bytes, size: int = SLICE) -> Iterator[bytes]:
    """Consecutive parts of a text, cut at single spaces between ASCII characters (left out)."""
    start = 0
    while len(text) - start > 2 * size and (cut := _CUT.search(text, start + size)):
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


def map_batches(
    df: DataFrame, function: Callable[..., Iterable[dict]], schema: str, *args
) -> DataFrame:
    """Apply ``function(batches, *args)``, which yields columns by name, within each partition."""
    spark_schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches, *args):
            arrays = [
                columns[f.name]
                if isinstance(columns[f.name], pa.Array)
                else pa.array(columns[f.name], f.type)
                for f in arrow
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, spark_schema)


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the checkpoint folder that the session names.

    Where the session names none, as in tests, a folder of the session's warehouse is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if base is None and context.getCheckpointDir() is not None:
        base = context.getCheckpointDir()
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/mishap-{uuid.uuid4().hex}"


# Without it, shuffle files stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STAGED: list[tuple[SparkSession, str]] = []


# Short rows, such as ids and counts, that one task writes at most.
ROWS_PER_FILE = 25_000


def gathered(df: DataFrame, rows: int | None) -> DataFrame:
    """Short rows in as many partitions as ``rows`` of them fill, if that number is given.

    A shuffle deals even few rows to all its partitions, each of which would write files of its own:
    on a local or remote folder these cost more than their rows. No row is moved by another shuffle.
    """
    return df if rows is None else df.coalesce(buckets(rows, ROWS_PER_FILE))


def staged(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The same rows, written as a table to the shared folder and read back: lineage ends here.

    What the write shuffled is removed when it has ended, as nothing reads it again. The table is
    deleted when the Python process ends, or by ``release``. For ``rows`` see ``gathered``.
    """
    spark, df = df.sparkSession, gathered(df, rows)
    path = shared_folder(spark)
    _STAGED.append((spark, path))
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def release() -> None:
    """Delete all staged tables; what still reads them must not be used afterwards."""
    while _STAGED:
        spark, path = _STAGED.pop()
        try:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # noqa: BLE001  the session may be gone; its folder is then left as it is
            return


def unstaged(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def held(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A small result, checkpointed in the shared folder; Spark removes it when it is unused."""
    shared_folder(df.sparkSession)
    return gathered(df, rows).checkpoint()


class UnitCache:
    """Results for parts of text that recur, kept by a Python worker across its tasks.

    ``prepare`` computes, all at once, what the parts of a batch still lack; afterwards ``found``
    answers for every part of the batch. Beyond ``limit`` entries the cache starts again from its
    seed, so memory is bounded by the limit and one batch.
    """

    def __init__(
        self, compute: Callable[[list[bytes]], Sequence], seed: dict | None = None, limit: int = 400_000
    ):
        self.compute, self.seed, self.limit = compute, seed or {}, limit
        self.found: dict = dict(self.seed)

    def prepare(self, units: Iterable[Sequence[bytes]]) -> None:
        if len(self.found) > self.limit + len(self.seed):
            self.found = dict(self.seed)
        missing: set[bytes] = set()
        for part in units:
            missing.update(filterfalse(self.found.__contains__, part))
        if missing:
            parts = list(missing)
            self.found.update(zip(parts, self.compute(parts)))


_ACTIVE: dict[tuple, UnitCache] = {}


def worker_cache(key: tuple, make: Callable[[], UnitCache]) -> UnitCache:
    """The cache of this Python worker for ``key``; a worker keeps that of one operator at a time."""
    if key not in _ACTIVE:
        _ACTIVE.clear()
        _ACTIVE[key] = make()
    return _ACTIVE[key]


def buckets(rows: int, per_bucket: int) -> int:
    return max(1, -(-rows // per_bucket))


def hash_bucket(number: int, *columns: str | Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(number)).cast("int")
