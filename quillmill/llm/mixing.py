"""Mixing sources to target weights by hash thresholds.

Each row has a hash of its id.  Words are summed by source and leading hash bits; the running
sums say in which bucket a source's budget ends, and only rows of that bucket are summed again,
by further bits and at last by the whole hash.  What a source gives is then the rows at or below
one threshold, found without sorting rows.  Thresholds nest: a larger budget keeps all rows of a
smaller one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, materialise, n_words, table

#: Hash bits in all, and those of the first two histograms.
BITS, FIRST, SECOND = 60, 12, 12


def row_hash(key: Column) -> Column:
    """60 bits that depend on the id alone, so that reruns and other sources agree."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """(source, source_size, target) from (source, size), one row for each source.

    Sources in order, nulls last, take the weights in turn and share `share` times the sum of all
    sizes.  No target exceeds cap times its source's size; what is over goes to the others by
    weight.  Sources are filled in order of cap * size / weight: one is full as long as the level
    that the rest would reach is at or above its own.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everywhere = Window.partitionBy()
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    w = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long")
    t = totals.withColumn("turn", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))).withColumn("w", w)
    t = t.withColumn("most", F.col("source_size") * cap)
    before = Window.orderBy(F.col("most") / F.col("w"), "turn").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("budget", F.sum("source_size").over(everywhere) * F.lit(float(share)))
    left = F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0))
    left_w = F.sum("w").over(everywhere) - F.coalesce(F.sum("w").over(before), F.lit(0))
    t = t.withColumn("level", left / left_w).withColumn("full", F.col("most") <= F.col("level") * F.col("w"))
    level = F.min(F.when(~F.col("full"), F.struct(F.col("most") / F.col("w"), "turn", "level"))).over(everywhere)["level"]
    return t.select("source", "source_size", F.when(F.col("full"), F.col("most").cast("double")).otherwise(level * F.col("w")).alias("target"))


def _of_source(rows: DataFrame, t: DataFrame) -> DataFrame:
    t = t.withColumnRenamed("source", "its_source")
    return rows.join(t, rows["source"].eqNullSafe(t["its_source"])).drop("its_source")


def _step(rows: DataFrame, state: DataFrame, shift: int) -> DataFrame:
    """One histogram: the bucket of each source in which its budget ends, and the sum below it."""
    bucket = F.shiftright("h", shift)
    hist = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("n"))
    sums = hist.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("bucket")))
    sums = _of_source(sums, bounded(state.select("source", "rest", "below"))).withColumn("upto", F.col("upto") + F.col("below"))
    ends = sums.where(F.col("upto") > F.col("rest")).groupBy("source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("below"))).alias("end"))
    ends = ends.select(F.col("source").alias("s"), F.col("end.bucket").alias("bucket"), F.col("end.below").alias("nearer"))
    kept = state.drop("bucket", "shift")
    return materialise(
        kept.join(ends, kept["source"].eqNullSafe(ends["s"]), "left")
        .withColumn("below", F.coalesce("nearer", "below"))
        .withColumn("shift", F.lit(shift))
        .drop("s", "nearer")
    )


def thresholds(rows: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    """(source, source_size, target, whole, last) from rows (source, size long, h long).

    A source gives all its rows `whole` times, and those with h <= last once more.  The row at
    which the budget ends is taken if that comes nearer to the target.  Rows of one hash go
    together.
    """
    t = targets(rows, weights, share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    state = t.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    state = materialise(state.withColumn("below", F.lit(0).cast("long")))
    state = _step(rows, state, BITS - FIRST)
    for shift in (BITS - FIRST - SECOND, 0):
        at = bounded(state.where("bucket is not null").select("source", "bucket", F.col("shift").alias("by")))
        inside = _of_source(rows, at).where(F.expr("shiftright(h, by) = bucket"))
        if shift:
            state = _step(inside, state, shift)
    sums = inside.groupBy("source", "h").agg(F.sum("size").alias("n"))
    sums = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("h")))
    sums = _of_source(sums, bounded(state.select("source", "rest", "below"))).withColumn("upto", F.col("upto") + F.col("below"))
    before = F.col("upto") - F.col("n")
    fits = (F.col("upto") <= F.col("rest")) | ((before <= F.col("rest")) & (F.col("upto") - F.col("rest") < F.col("rest") - before))
    last = sums.where(fits).groupBy("source").agg(F.max("h").alias("last")).withColumnRenamed("source", "s")
    start = F.when(F.col("bucket").isNull(), F.lit((1 << BITS) - 1)).otherwise(F.expr("shiftleft(bucket, shift)") - 1)
    start = F.when(F.col("rest") <= 0, F.lit(-1)).otherwise(start)
    found = state.join(last, state["source"].eqNullSafe(last["s"]), "left")
    return materialise(found.select("source", "source_size", "target", "whole", F.when(F.col("rest") <= 0, F.lit(-1)).otherwise(F.coalesce("last", start)).cast("long").alias("last")))


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col).cast("string")).alias("size"),
        row_hash(F.col(id_col)).alias("h"),
    )


def _copies() -> Column:
    return F.col("whole") + F.when(F.col("h") <= F.col("last"), 1).otherwise(0)


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for each row of docs.

    size counts words; null and empty texts have none, and go with their hash.  A null source is
    a source of its own, last in order.  Rows of one id, null among them, share a hash and so
    their fate.  An empty table gives no rows.  Other columns are not looked at.
    """
    rows = materialise(_rows(docs, id_col, text_col, source_col))
    found = _of_source(rows, bounded(thresholds(rows, **how)))
    return found.select("doc_id", "source", "size", "source_size", "target", _copies().alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with the columns of docs."""
    rows = materialise(_rows(docs, id_col, text_col, source_col).drop("doc_id"))
    t = bounded(thresholds(rows, **how)).select(F.col("source").alias("_mix_source"), "whole", "last")
    t = t.select("_mix_source", F.struct("whole", "last").alias("_mix"))
    joined = docs.withColumn("_mix_h", row_hash(F.col(id_col))).join(t, F.col(source_col).cast("string").eqNullSafe(F.col("_mix_source")))
    n = F.col("_mix.whole") + F.when(F.col("_mix_h") <= F.col("_mix.last"), 1).otherwise(0)
    return joined.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), n))).select(*[docs[c] for c in docs.columns])


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    found = mixture(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP10_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         substr(md5(coalesce(doc_id::varchar, '')), 1, 15) as h
  from documents
), s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as turn from d group by source
), w as (
  select *, ([5, 2, 1])[((turn - 1) % 3 + 1)::int] as w, source_size * 2 as most from s
), f as (
  select *,
    (sum(source_size) over ())::double * 1.5 - coalesce(sum(most) over b, 0)::double as left_size,
    (sum(w) over () - coalesce(sum(w) over b, 0))::double as left_w
  from w window b as (order by most::double / w, turn rows between unbounded preceding and 1 preceding)
), g as (
  select *, left_size / left_w as level, most <= left_size / left_w * w as is_full from f
), t as (
  select source, source_size,
    case when is_full then most::double
         else (select arg_min(level, (most::double / w, turn)) from g where not is_full) * w end as target
  from g
), u as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from t
), v as (
  select *, target - whole * source_size as rest from u
), c as (
  select source, h, sum(size) as n, sum(sum(size)) over (partition by source order by h) as upto from d group by source, h
), l as (
  select c.source, max(h) as last from c join v on c.source is not distinct from v.source
  where rest > 0 and (upto <= rest or (upto - n <= rest and upto - rest < rest - (upto - n)))
  group by c.source
)
select doc_id, size, v.source_size, v.target,
       (size * (whole + case when h <= l.last then 1 else 0 end))::bigint as taken
from d join v on d.source is not distinct from v.source
left join l on l.source is not distinct from v.source
"""
