"""``python -m checks.compare SF_DIR [NAME ...]``: run queries and compare them with their SQL."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks import catalog


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for row in df.itertuples(index=False, name=None):
        rows.append(tuple("null" if pd.isna(v) else repr(v.item() if hasattr(v, "item") else v) for v in row))
    return sorted(rows)


def oracle(con, sql: str) -> pd.DataFrame:
    return con.sql(sql).df()


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(catalog.QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            got = catalog.QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in catalog.ORACLES:
                print(f"{name:28s} rows {len(got):7d}  {took:6.2f}s  (no SQL)", flush=True)
                continue
            want = oracle(con, catalog.ORACLES[name])
            same = sorted(got.columns) == sorted(want.columns)
            types = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns if same and got[c].dtype != want[c].dtype}
            a, b = (normal(got), normal(want)) if same else ([], [0])
            ok = a == b
            bad += not ok
            print(f"{name:28s} rows {len(got):7d}  {took:6.2f}s  {'same' if ok else 'DIFFERENT'} {types or ''}", flush=True)
            if not ok:
                print("   columns", sorted(got.columns), sorted(want.columns), len(a), len(b))
                for x, y in [(x, y) for x, y in zip(a, b) if x != y][:3]:
                    print("   spark", x, "\n   sql  ", y)
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} FAILED {type(error).__name__}: {str(error)[:600]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
