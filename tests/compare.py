"""Run registered queries against their SQL on one scale and compare the rows."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


# Spark's short type names for what DuckDB reports.
TYPE_NAMES = {
    "BIGINT": "bigint", "INTEGER": "int", "TINYINT": "tinyint", "VARCHAR": "string",
    "DOUBLE": "double", "BOOLEAN": "boolean",
}


def spark_rows(df) -> tuple[list[tuple[str, str]], Counter]:
    columns = sorted(df.columns)
    types = dict(df.dtypes)
    rows = df.select(*columns).collect()
    return [(c, types[c]) for c in columns], Counter(tuple(_cell(v) for v in r) for r in rows)


def oracle_rows(con, sql: str) -> tuple[list[tuple[str, str]], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [TYPE_NAMES.get(str(d[1]), str(d[1])) for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = result.fetchall()
    return [(names[i], types[i]) for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def main() -> int:
    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    import __spark_entry__ as registry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="twintext-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), registry.oracle_sql(), 0
    for name, query in registry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            columns, rows = spark_rows(df)
        except Exception as error:  # report and go on with the next query
            print(f"{name:24} SPARK ERROR {str(error)[:600]}", flush=True)
            bad += 1
            continue
        seconds = time.time() - started
        if name not in oracles:
            print(f"{name:24} rows only {sum(rows.values())} {seconds:.1f}s", flush=True)
            continue
        started = time.time()
        try:
            expected_columns, expected = oracle_rows(con, oracles[name])
        except Exception as error:
            print(f"{name:24} ORACLE ERROR {str(error)[:600]}", flush=True)
            bad += 1
            continue
        same = columns == expected_columns and rows == expected
        bad += not same
        print(
            f"{name:24} {'ok' if same else 'DIFFERENT'} {sum(rows.values())} rows "
            f"spark {seconds:.1f}s oracle {time.time() - started:.1f}s",
            flush=True,
        )
        if not same:
            print("  columns", columns, expected_columns)
            print("  only spark", list((rows - expected).items())[:3])
            print("  only oracle", list((expected - rows).items())[:3], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
