"""Run queries beside their SQL and report differences: ``python -m workbench.compare DIR [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from rainledger.session import configure

from .oracles import ORACLES
from .registry import QUERIES


def connect(sf_dir: str):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _rows(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


# Spark type -> the type DuckDB should answer with.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(name: str, spark: SparkSession, sf_dir: str, db) -> list[str]:
    """What differs between a query and its SQL: columns, types, row counts, first unlike rows."""
    df = QUERIES[name](spark, sf_dir)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    answer = db.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    theirs = _rows(columns, answer.fetchall())
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(columns)}"]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    other = {c: (k, kinds[c]) for c, k in df.dtypes if TYPES.get(k) != kinds[c]}
    if other:
        return [f"types {other}"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}"]
    if not ours:
        return ["no rows"]
    unlike = [(o, t) for o, t in zip(ours, theirs) if o != t]
    return [f"{len(unlike)} unlike rows of {len(ours)}: {unlike[0][0]} against {unlike[0][1]}"] if unlike else []


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    spark = configure(builder.config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    bad = 0
    for name in names:
        begun = time.time()
        try:
            found = differences(name, spark, sf_dir, db)
        except Exception as error:  # the report goes on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - begun:.1f}s", *found, flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    spark.stop()


if __name__ == "__main__":
    main()
