"""Incremental runs: a checkpoint in place of lists of what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import last_by_key, merge_upsert
from ..sources.writers import current, publish


def follow(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def upsert_stream(stream: DataFrame, table: str, checkpoint: str, key: list[str], order: str, policy: dict[str, str]):
    """Merge each batch of a stream into a table; starts a query over what is there now."""
    schema = stream.drop(order).schema

    def merge(batch: DataFrame, _: int) -> None:
        state = current(batch.sparkSession, table, schema)
        publish(merge_upsert(state, last_by_key(batch, key, order).drop(order), key, policy), table)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str = "ts", by: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window; events later than `late` are dropped."""
    e = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return e.groupBy(F.window("_ts", width).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def fresh(events: DataFrame, key: str, ts: str = "ts", late: str = "2 hours") -> DataFrame:
    """Each key once within the watermark."""
    return events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late).dropDuplicatesWithinWatermark([key])
