"""Run queries and their SQL side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries


def local_session(cores: str = "8", **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("caselake")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def _duck_type(spark_type: str) -> str:
    return _TYPES.get(spark_type, spark_type.upper())


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a query and its SQL (columns by name, rows as a multiset), or None."""
    names = sorted(df.columns)
    mine = sorted(map(repr, (tuple(r) for r in df.select(*names).collect())))
    relation = con.sql(sql)
    types = dict(zip(relation.columns, map(str, relation.types)))
    if sorted(types) != names:
        return f"columns {names} against {sorted(types)}"
    wrong = {c: (t, types[c]) for c, t in df.dtypes if _duck_type(t).replace(" ", "") != types[c].replace(" ", "")}
    if wrong:
        return f"types {wrong}"
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(map(repr, relation.project(quoted).fetchall()))
    if mine != theirs:
        only = next((p for p in zip(mine, theirs) if p[0] != p[1]), None)
        return f"{len(mine)} rows against {len(theirs)}; first difference {only}"
    return None


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    chosen = args[1:] or list(queries())
    spark, con, sql = local_session(), connect(sf_dir), oracle_sql()
    failures = 0
    for name in chosen:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            if name in sql:
                problem = difference(df, con, sql[name])
                verdict = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                problem, verdict = None, f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            problem = verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{name:36s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print(f"{len(chosen) - failures} of {len(chosen)} agree")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
