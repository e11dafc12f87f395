"""Packing: length buckets that minimise padding, and batches of a token budget.

The histogram of lengths over all documents goes through a dynamic programme that places a given
number of bucket bounds so that padding each document to its bucket's bound costs least.  Inside a
bucket documents are numbered in an order that depends on their ids alone, and each run of
budget // bound documents is a batch.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, n_words, table

BUCKETS, BUDGET = 8, 65_536
#: Lengths up to FINE, the budget, are bins of their own, so that bounds are optimal there; documents
#: above it are batches of their own, and their bins are 1 / FINE of their power of two wide.
FINE = 65_536
#: Numbers inside a bucket are given in so many parts by hash, which are then laid end to end.
PARTS = 1024


def length_bin(length: Column) -> Column:
    """The bin of a length; bins keep the order of lengths."""
    power = F.greatest(F.floor(F.log2(F.greatest(length, F.lit(1)) + 0.5)).cast("int") - (FINE.bit_length() - 1), F.lit(0))
    return (power.cast("long") * (1 << 40)) + F.call_function("shiftright", length, power)


def histogram(sizes: DataFrame) -> list[tuple[int, int, int]]:
    """(greatest length, documents, sum of lengths) for each bin of the lengths, ascending."""
    bins = sizes.groupBy(length_bin(F.col("length")).alias("bin")).agg(F.max("length").alias("top"), F.count("*").alias("n"), F.sum("length").alias("total"))
    return sorted((r["top"], r["n"], r["total"]) for r in bins.collect())


def best_bounds(hist: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Bucket bounds of least padding, ascending; fewer than asked if there are fewer lengths.

    cost(i, j) of bins i..j in one bucket is top[j] * documents - lengths.  It satisfies the
    quadrangle inequality, so that the best split moves on with j and each layer is filled by
    divide and conquer.  Of equal costs the first split is taken.
    """
    k = len(hist)
    if not k:
        return []
    top, n, total = (np.array(x, np.float64) for x in zip(*hist))
    cn, ct = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(total)]
    layer = top * cn[1:] - ct[1:]  # one bucket for bins 0..j
    splits: list[np.ndarray] = []
    for _ in range(1, min(buckets, k)):
        new, split = np.full(k, np.inf), np.zeros(k, np.int64)
        todo = [(0, k - 1, 0, k - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j) + 1)  # the last bucket has bins i..j, those before it 0..i-1
            cost = np.where(i > 0, layer[i - 1], np.where(i == 0, 0.0, np.inf)) + top[j] * (cn[j + 1] - cn[i]) - (ct[j + 1] - ct[i])
            best = int(cost.argmin())
            new[j], split[j] = cost[best], i[best]
            todo += [(lo, j - 1, a, int(i[best])), (j + 1, hi, int(i[best]), b)]
        layer = new
        splits.append(split)
    bounds, j = [], k - 1
    for split in reversed(splits):
        bounds.append(int(top[j]))
        j = int(split[j]) - 1
        if j < 0:
            break
    else:
        bounds.append(int(top[j]))
    return sorted(bounds)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, budget: int = BUDGET, parts: int = PARTS, length: Column | None = None) -> DataFrame:
    """(doc_id, length, bucket, bound, batch, slot, padding) for each row of docs.

    Lengths are words unless a column is given; null and empty texts have length 0.  batch counts
    from 0 inside its bucket, slot inside its batch; a batch has budget // bound documents, one at
    least, so that a document above the budget is a batch of its own.  Repeated rows are packed
    each; rows of one id are told apart by length alone.  An empty table gives no rows.
    """
    size = n_words(F.col(text_col).cast("string")) if length is None else F.coalesce(length.cast("long"), F.lit(0))
    sizes = materialise(docs.select(F.col(id_col).alias("doc_id"), size.alias("length")))
    bounds = best_bounds(histogram(sizes), buckets)
    if not bounds:
        bounds = [0]
    bucket = F.lit(len(bounds) - 1)
    bound = F.lit(bounds[-1]).cast("long")
    for i, b in reversed(list(enumerate(bounds[:-1]))):
        bucket = F.when(F.col("length") <= b, i).otherwise(bucket)
        bound = F.when(F.col("length") <= b, F.lit(b).cast("long")).otherwise(bound)
    h = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = sizes.select("doc_id", "length", bucket.alias("bucket"), bound.alias("bound"), h.alias("h"))
    rows = rows.withColumn("part", F.pmod("h", F.lit(parts)))
    own = Window.partitionBy("bucket", "part").orderBy("h", "doc_id", "length")
    counts = rows.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # at most buckets * parts rows, whatever the input
    placed = rows.withColumn("no", F.row_number().over(own) - 1).join(F.broadcast(offsets), ["bucket", "part"])
    room = F.greatest(F.floor(F.lit(budget) / F.greatest("bound", F.lit(1))), F.lit(1)).cast("long")
    no = F.col("no") + F.col("offset")
    return placed.select("doc_id", "length", "bucket", "bound", F.floor(no / room).cast("long").alias("batch"), F.pmod(no, room).cast("long").alias("slot"), (F.col("bound") - F.col("length")).alias("padding"))


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
