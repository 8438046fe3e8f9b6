"""Side-by-side check of every registered query against its SQL in DuckDB.

Run as `python tests/check_sql.py [sf_dir] [name ...]`.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


TIMES = {}


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.6f}" if value else "0.000000"
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    return str(value)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in data)


def compare(spark, con, run, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    start = time.time()
    df = run(spark, sf_dir)
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    TIMES["spark"] = time.time() - start
    if sql is None:
        return None
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows / {len(theirs)} rows"
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        return f"{len(different)} of {len(ours)} rows differ, e.g. {str(different[0])[:600]}"
    return None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, run, sqls.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {TIMES.get('spark', 0):.1f}s of {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
