"""Small sides of joins: their size is counted before they are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a side that is broadcast in one go.
BLOCK = 4096


def blocks(rows: DataFrame, key: str, block: int = BLOCK) -> list[DataFrame]:
    """rows in parts of about `block` rows each, by hash of a unique key; one part if they are few."""
    parts = max(1, -(-rows.count() // block))
    if parts == 1:
        return [rows]
    return [rows.where(F.pmod(F.xxhash64(key), F.lit(parts)) == i) for i in range(parts)]


def bounded(rows: DataFrame, most: int = 20_000) -> DataFrame:
    """rows for an equi-join: broadcast if counting shows that they are few, else left to the planner."""
    return F.broadcast(rows) if rows.count() <= most else rows


def united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def spread(rows: DataFrame, key: str) -> DataFrame:
    """rows dealt by a unique key, for work that is dear by the row: a file of few bytes or one row group is read by a task or two, however many rows it holds."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
