"""Runs registered queries against their SQL forms: ``python -m tests.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _plain(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(tuple(_plain(r[n]) for n in names) for r in df.collect())


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = sorted(tuple(_plain(r[i]) for i in order) for r in cursor.fetchall())
    return [columns[i] for i in order], rows


def main() -> None:
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark, con = session(), oracle(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            names, rows = spark_rows(run(spark, sf))
            spent = time.time() - start
            if name not in sqls:
                print(f"ROWS {name} {len(rows)} rows {spent:.1f}s", flush=True)
                continue
            start = time.time()
            want_names, want = sql_rows(con, sqls[name])
            same = names == want_names and rows == want
            bad += not same
            print(f"{'OK  ' if same else 'DIFF'} {name} {len(rows)}/{len(want)} rows spark {spent:.1f}s sql {time.time() - start:.1f}s", flush=True)
            if not same:
                print("   ", names, want_names)
                left, right = set(rows) - set(want), set(want) - set(rows)
                for label, some in (("spark", left), ("sql", right)):
                    for row in sorted(some)[:2]:
                        print("   ", label, len(some), str(row)[:400])
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name} {type(error).__name__}: {str(error)[:900]}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
