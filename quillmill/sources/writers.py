"""Writers: versions of a table that are swapped in whole, and lines by document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def version(spark: SparkSession, table: str) -> int:
    """The greatest version that is complete; 0 for none."""
    p, fs = _fs(spark, table)
    if not fs.exists(p):
        return 0
    done = [s.getPath().getName()[2:] for s in fs.listStatus(p) if s.getPath().getName().startswith("v=") and fs.exists(_fs(spark, f"{s.getPath()}/_SUCCESS")[0])]
    return max(map(int, done), default=0)


def publish(state: DataFrame, table: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> int:
    """Write a state as the next version; readers see it once it is complete."""
    spark = state.sparkSession
    n = version(spark, table) + 1
    rows = state.sortWithinPartitions(*sort_by) if sort_by else state
    w = rows.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{table}/v={n}")
    return n


def current(spark: SparkSession, table: str, schema=None) -> DataFrame:
    """The last complete version, or an empty frame of the schema."""
    n = version(spark, table)
    if n == 0:
        return spark.createDataFrame([], schema)
    return spark.read.parquet(f"{table}/v={n}")


def lines_by(rows: DataFrame, path: str, key: str = "doc_id", mode: str = "errorifexists") -> None:
    """JSON lines in a folder for each document; mode append adds to what is there."""
    rows.write.mode(mode).partitionBy(key).json(path)


def result_and_errors(rows: DataFrame, path: str, error_col: str = "error") -> None:
    """Good rows and error rows in two folders."""
    rows.where(F.col(error_col).isNull()).drop(error_col).write.mode("append").json(f"{path}/ok")
    rows.where(F.col(error_col).isNotNull()).write.mode("append").json(f"{path}/errors")


def collision_names(files: DataFrame, label: str = "label", name: str = "name") -> DataFrame:
    """files with `target`: label/name, numbered _(n) from the second of a name on."""
    from pyspark.sql import Window

    no = F.row_number().over(Window.partitionBy(label, name).orderBy("path"))
    stem, dot = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 2)
    return files.withColumn("target", F.concat(F.col(label), F.lit("/"), stem, F.when(no > 1, F.concat(F.lit("_("), (no - 1).cast("string"), F.lit(")"))).otherwise(""), dot))
