"""Run queries and their SQL side by side: python -m checks.compare FOLDER [name ...]"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = ("documents", "embeddings", "conversations", "pages", "benchmark", "labels", "orders")


def main(folder: str, names: list[str]) -> None:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    for name in names or QUERIES:
        try:
            start = time.time()
            df = QUERIES[name](spark, folder)
            columns = sorted(df.columns)
            rows = [tuple(r) for r in df.select(columns).collect()]
            took = time.time() - start
            if name not in ORACLES:
                print(f"{name:26} rows {len(rows):8} {took:6.1f}s", flush=True)
                continue
            start = time.time()
            cursor = con.execute(ORACLES[name])
            got = [d[0] for d in cursor.description]
            order = [got.index(c) for c in columns]
            wanted = [tuple(r[i] for i in order) for r in cursor.fetchall()]
            sql_took = time.time() - start
            same = Counter(rows) == Counter(wanted) and sorted(got) == columns
            print(f"{name:26} {'same' if same else 'DIFFERENT'} {len(rows):8} {len(wanted):8} "
                  f"{took:6.1f}s sql {sql_took:6.1f}s", flush=True)
            if not same:
                print("   only spark", list((Counter(rows) - Counter(wanted)).items())[:2])
                print("   only sql  ", list((Counter(wanted) - Counter(rows)).items())[:2])
        except Exception as error:  # keep going, report at the end of the line
            print(f"{name:26} FAILED {type(error).__name__}: {str(error)[:600]}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
