"""Queries by name, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(x) -> str:
    if x is None:
        return "null"
    if isinstance(x, bool):
        return str(x).lower()
    if isinstance(x, (int, float)):
        return str(x)
    if isinstance(x, list):
        return "[" + ", ".join(map(literal, x)) + "]"
    return "'" + x.replace("'", "''") + "'"


_SQL_TYPES = {"long": "bigint", "string": "varchar", "boolean": "boolean", "double": "double", "int": "integer"}


def rows_sql(ddl: str, rows: list[tuple]) -> str:
    """A select of fixed rows, typed as in ddl."""
    cols = [c.split() for c in ddl.split(", ")]
    names = ", ".join(c[0] for c in cols)
    casts = ", ".join(f"{n}::{_SQL_TYPES.get(t, t.replace('array<string>', 'varchar[]'))} as {n}" for n, t in cols)
    return f"select {casts} from (values {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) v({names})"
