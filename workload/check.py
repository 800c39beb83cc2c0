"""Run queries beside their SQL in DuckDB and compare rows as multisets.

    python -m workload.check [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb
import pandas as pd
from pyspark.sql import SparkSession


def rows_of(frame) -> Counter:
    frame = frame[sorted(frame.columns)]
    return Counter(
        tuple(None if pd.isna(v) else v for v in row)
        for row in frame.astype(object).itertuples(index=False, name=None)
    )


def compare(spark: SparkSession, sf_dir: str, names: list[str]) -> list[str]:
    from workload.queries import ORACLES, QUERIES

    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    failed = []
    for name in names or QUERIES:
        begin = time.time()
        ours = QUERIES[name](spark, sf_dir).toPandas()
        spent = time.time() - begin
        theirs = db.execute(ORACLES[name]).df()
        same_columns = sorted(ours.columns) == sorted(theirs.columns)
        same = same_columns and rows_of(ours) == rows_of(theirs)
        print(f"{'ok  ' if same else 'FAIL'} {name:28s} {len(ours):8d} rows {spent:6.2f} s", flush=True)
        if not same:
            failed.append(name)
            if same_columns:
                a, b = rows_of(ours), rows_of(theirs)
                print("   only ours  ", [str(r)[:300] for r in list((a - b))[:2]])
                print("   only theirs", [str(r)[:300] for r in list((b - a))[:2]])
            else:
                print("  ", sorted(ours.columns), sorted(theirs.columns))
    return failed


if __name__ == "__main__":
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    bad = compare(session, folder, sys.argv[2:])
    print("failed:", bad)
    sys.exit(bool(bad))
