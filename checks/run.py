"""Run queries next to their SQL and report differences.

    python -m checks.run [--sf DIR] [key ...]
"""

from __future__ import annotations

import argparse
import math
import os
import time

import duckdb

from checks.oracles import ORACLES
from checks.queries import REGISTRY
from specloom.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _sortable(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value))
    return (1, repr(value))


def normal(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=lambda r: [_sortable(v) for v in r])


def compare(spark, con, key: str, sf_dir: str) -> str:
    df = REGISTRY[key](spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if key not in ORACLES:
        return f"rows only ({len(got)})"
    cursor = con.execute(ORACLES[key])
    columns = [d[0] for d in cursor.description]
    want = normal(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS DIFFER spark={sorted(df.columns)} sql={sorted(columns)}"
    if len(got) != len(want):
        return f"ROWS DIFFER spark={len(got)} sql={len(want)}: {got[:2]} | {want[:2]}"
    different = [(g, w) for g, w in zip(got, want) if [_sortable(v) for v in g] != [_sortable(v) for v in w]]
    if different:
        return f"VALUES DIFFER in {len(different)} of {len(got)}: {different[:3]}"
    return f"equal ({len(got)} rows)"


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("keys", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        "specloom-checks",
        f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(args.sf)
    for key in args.keys or REGISTRY:
        started = time.time()
        try:
            outcome = compare(spark, con, key, args.sf)
        except Exception as error:  # reported, and the other queries still run
            outcome = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        print(f"{key:28s} {time.time() - started:6.1f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main()
