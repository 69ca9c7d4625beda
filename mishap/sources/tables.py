"""Reading and writing of incident and result tables."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap import schemas as S
from mishap.operators.hygiene import quoted

CSV_DIALECT = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# What a quoted empty field reads as, to tell it from a missing one.
EMPTY = "\ue000"
# Times keep their microseconds.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = S.RAW, multiline: bool = False
) -> DataFrame:
    """CSV with a header, typed by column name.

    Declared columns get their type wherever they stand in the file, and text that does not fit
    becomes null; other columns stay text. Quotes inside a field are doubled, blanks around a field
    belong to it. Large files are split between tasks, so a line break ends a row; with
    ``multiline`` fields may hold line breaks, at the price of reading each file in one task.
    """
    text = spark.read.csv(path, header=True, multiLine=multiline, emptyValue=EMPTY, **CSV_DIALECT)
    columns = []
    for name in text.columns:
        column = F.replace(F.col(quoted(name)), F.lit(EMPTY), F.lit(""))
        if name in schema.names:
            dtype = schema[name].dataType
            if isinstance(dtype, T.TimestampType):
                column = F.try_to_timestamp(column)
            elif not isinstance(dtype, T.StringType):
                column = column.try_cast(dtype)
        columns.append(column.alias(name))
    return text.select(*columns)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table written by ``write_table``: parquet, or CSV when the path says so.

    Written CSV may hold line breaks and has a file per task, so each file is read by one task.
    """
    if path.rstrip("/").endswith(".csv"):
        return read_csv(spark, path, schema or T.StructType([]), multiline=True)
    return spark.read.parquet(path)


def ordered(df: DataFrame, order_by: str | None, total_order: bool = False) -> DataFrame:
    """Rows sorted inside each task, or with ``total_order`` across the table by a range shuffle."""
    if not order_by:
        return df
    key = quoted(order_by)
    return df.orderBy(key) if total_order else df.sortWithinPartitions(key)


def write_table(
    df: DataFrame, path: str, order_by: str | None = None, total_order: bool = False
) -> None:
    """Write a table from the executors, one file per task, sorted as ``ordered`` says."""
    _write(ordered(df, order_by, total_order), path)


def write_observed(
    df: DataFrame, path: str, order_by: str | None = None, total_order: bool = False
) -> dict:
    """``write_table`` that returns the row count and the columns that have missing values.

    The counts ride on the tasks that write, so they need no pass of their own.
    """
    seen = Observation()
    counts = [
        F.count_if(F.col(quoted(c)).isNull()).alias(f"missing_{i}") for i, c in enumerate(df.columns)
    ]
    rows = ordered(df, order_by, total_order)
    _write(rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), path)
    values = seen.get
    missing = {c: values[f"missing_{i}"] for i, c in enumerate(df.columns)}
    return {
        "rows": values["rows"],
        "cols": len(df.columns),
        "missing": {c: n for c, n in missing.items() if n},
    }


def write_small(df: DataFrame, path: str) -> None:
    """Write a result that is known to be a few rows as one file, in its own order."""
    _write(df.coalesce(1), path)


def _write(df: DataFrame, path: str) -> None:
    writer = df.write.mode("overwrite")
    if path.rstrip("/").endswith(".csv"):
        writer.options(**CSV_TIMES).csv(path, header=True, **CSV_DIALECT)
    else:
        writer.parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: as the session names it, else in its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_STAGED: list[tuple[SparkSession, str]] = []


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This ends the lineage: what follows survives lost executors without repeating the work before
    it, and reads only the columns it needs. The table is deleted by ``release``, at the latest when
    the Python process ends.
    """
    path = f"{shared_folder(df.sparkSession)}/mishap/{name}-{uuid.uuid4().hex}"
    _STAGED.append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


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
