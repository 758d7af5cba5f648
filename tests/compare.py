"""Compare registered queries with their SQL: ``python tests/compare.py [dir] [names]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _key(row):
    return tuple((v is not None, type(v).__name__, v) for v in row)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, and rows in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=_key)


def difference(spark_df, con, sql: str) -> str | None:
    """None if both give the same rows, else where they part."""
    ours = rows_of(spark_df.columns, spark_df.collect())
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a}\n  != {b}"
    return None if ours[1] else "both empty"


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(oracle)), sorted(set(oracle) - set(queries)))
    bad = 0
    for name in sys.argv[2:] or queries:
        began = time.time()
        try:
            found = difference(queries[name](spark, sf_dir), con, oracle[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - began:.1f}s", flush=True)
        if found:
            print("  ", found)
    print("differences:", bad)


if __name__ == "__main__":
    main()
