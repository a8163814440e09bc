"""Compare registered queries with their SQL twins in DuckDB.

``python -m tests.oracle [name ...]`` prints one line per query; the folder is
taken from ``ORACLE_SF_DIR`` (default sf0.01).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
SPARK_KIND = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "double": "float", "float": "float",
    "string": "text", "boolean": "bool", "timestamp_ntz": "time", "date": "date",
}
DUCK_KIND = {
    "BIGINT": "int", "INTEGER": "int", "SMALLINT": "int", "TINYINT": "int", "HUGEINT": "huge", "DOUBLE": "float",
    "FLOAT": "float", "VARCHAR": "text", "BOOLEAN": "bool", "TIMESTAMP": "time", "DATE": "date",
}


def connect(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"DEC{value}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return repr(value)


def compare(spark_df, con, sql: str) -> list[str]:
    problems = []
    rel = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in rel.description}
    duck_rows = rel.fetchall()
    duck_names = [d[0] for d in rel.description]
    spark_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    if sorted(duck_names) != sorted(spark_types):
        return [f"columns {sorted(spark_types)} != {sorted(duck_names)}"]
    for name, kind in spark_types.items():
        ours = SPARK_KIND.get(kind, kind)
        theirs = DUCK_KIND.get(duck_types[name], duck_types[name])
        exact = {"bigint": "BIGINT", "int": "INTEGER"}
        if ours != theirs or (os.environ.get("ORACLE_EXACT") and kind in exact and exact[kind] != duck_types[name]):
            problems.append(f"type of {name}: {kind} vs {duck_types[name]}")
    names = sorted(duck_names)
    spark_rows = spark_df.select(*[f"`{n}`" for n in names]).collect()
    place = [duck_names.index(n) for n in names]
    a = sorted(tuple(plain(v) for v in row) for row in spark_rows)
    b = sorted(tuple(plain(row[i]) for i in place) for row in duck_rows)
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        problems.append(f"values differ: {len(only_a)} / {len(only_b)}; {names} ours {only_a[:2]} theirs {only_b[:2]}")
    if not a:
        problems.append("no rows")
    return problems


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sqls = connect(), entry.queries(), entry.oracle_sql()
    wanted = [n for n in queries if not argv or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in argv)]
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = queries[name](spark, SF_DIR)
            if name in sqls:
                problems = compare(df, con, sqls[name])
            else:
                count = df.count()
                problems = [] if count else ["no rows"]
        except Exception as error:  # report and go on
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        took = time.time() - start
        if problems or took > 6 or argv:
            print(f"{'FAIL' if problems else 'ok  '} {name} {took:.1f}s {'' if name in sqls else '(rows only)'}", *problems, flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} right", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
