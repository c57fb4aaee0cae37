"""Compare registered queries with their oracles: ``python -m checks [sf_dir] [name-prefix ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.compare import compare
from checks.load import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:]) or ("",)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name, query in QUERIES.items():
        if not name.startswith(prefixes):
            continue
        started = time.monotonic()
        try:
            got = query(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"ERROR {name}: {str(e)[:600]}")
            bad += 1
            continue
        seconds = time.monotonic() - started
        if name not in ORACLES:
            print(f"rows  {name}: {len(got)} rows, {seconds:.2f}s")
            continue
        try:
            problem = compare(got, db.execute(ORACLES[name]).df())
        except Exception as e:  # noqa: BLE001
            problem = f"oracle failed: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok   ' if problem is None else 'DIFF '} {name}: {len(got)} rows, {seconds:.2f}s {problem or ''}")
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
