"""Chunks put together again: ordered texts of documents, whole or within a budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, text


def ordered_concat(rows: DataFrame, key: str, order: list[str], text_col: str = "text", separator: str = "\n\n") -> DataFrame:
    """(key, text, n): the filled texts of each key in order."""
    filled = rows.where(strip(text(F.col(text_col))) != "")
    got = F.array_sort(F.collect_list(F.struct(*order, F.col(text_col).alias("_t"))))
    return filled.groupBy(key).agg(F.array_join(F.transform(got, lambda s: s["_t"]), separator).alias("text"), F.count("*").alias("n"))


def joined_chunks(rows: DataFrame, key: str = "doc_id", order: str = "chunk_index", ids: str = "chunk_id", section: str = "section", text_col: str = "text", wanted: list[str] | None = None) -> DataFrame:
    """(key, text, chunk_ids, sections): the stripped texts of each key in order, two empty lines apart, and where they are from.

    Texts without characters are left out, with their ids; of equal order the lesser id is first.
    With `wanted`, rows of other named sections are left out; a key without rows gives none.
    """
    r = rows if wanted is None else wanted_sections(rows, wanted, section)
    r = r.select(key, F.struct(F.col(order).alias("o"), F.col(ids).alias("id"), text(F.col(section)).alias("s"), strip(text(F.col(text_col))).alias("t")).alias("c")).where("c.t <> ''")
    got = r.groupBy(key).agg(F.array_sort(F.collect_list("c")).alias("c"))
    return got.select(key, F.array_join("c.t", "\n\n\n").alias("text"), F.col("c.id").alias("chunk_ids"), F.col("c.s").alias("sections"))


def budgeted_concat(rows: DataFrame, key: str, order: list[str], budget: int, text_col: str = "text", separator: str = "\n\n") -> DataFrame:
    """ordered_concat() of at most `budget` characters.

    A block costs its length and that of a separator; the first that does not fit is cut to what
    is left, and nothing follows it.
    """
    gap = len(separator)
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    filled = rows.where(strip(text(F.col(text_col))) != "").withColumn("_before", F.coalesce(F.sum(F.length(text_col) + gap).over(w), F.lit(0)))
    kept = filled.where(F.col("_before") < budget)
    cut = F.when(F.col("_before") + F.length(text_col) + gap <= budget, F.col(text_col)).otherwise(F.substring(F.col(text_col), F.lit(1), (F.lit(budget) - F.col("_before")).cast("int")))
    return ordered_concat(kept.withColumn(text_col, cut), key, order, text_col, separator)


def wanted_sections(rows: DataFrame, sections: list[str], column: str = "section") -> DataFrame:
    return rows.where((text(F.col(column)) == "") | F.col(column).isin(*sections))


def of_types(rows: DataFrame, types: list[str], column: str = "clause_type") -> DataFrame:
    """Rows that have one of the types in their array."""
    return rows.where(F.arrays_overlap(column, F.array(*map(F.lit, types))))


def parts(rows: DataFrame, key: str, order: list[str], marker: Column, first: str = "p1", overlap: int = 0, part_col: str = "part") -> DataFrame:
    """rows with the part that the last marker before or at them began.

    With overlap the last rows of each part come once more at the head of the next one, with
    overlapped true.
    """
    w = Window.partitionBy(key).orderBy(*order)
    tagged = rows.withColumn(part_col, F.coalesce(F.last(marker, True).over(w), F.lit(first))).withColumn("overlapped", F.lit(False))
    if not overlap:
        return tagged
    back = Window.partitionBy(key, part_col).orderBy(*[F.desc(c) for c in order])
    names = tagged.groupBy(key, part_col).agg(F.min(F.struct(*order)).alias("_at"))
    follows = names.withColumn("_next", F.lead(part_col).over(Window.partitionBy(key).orderBy("_at"))).select(key, part_col, "_next")
    tail = tagged.withColumn("_no", F.row_number().over(back)).where(F.col("_no") <= overlap).join(follows, [key, part_col]).where("_next is not null")
    again = tail.withColumn(part_col, F.col("_next")).withColumn("overlapped", F.lit(True)).drop("_no", "_next")
    return tagged.unionByName(again.select(*tagged.columns))


def seed_clauses(chunks: DataFrame) -> DataFrame:
    """The clause that each contract chunk starts from."""
    return chunks.select("doc_id", F.col("chunk_id").alias("clause_id"), text(F.col("clause_no")).alias("clause_no"), text(F.col("section")).alias("title"), text(F.col("text")).alias("text"), F.coalesce("clause_type", F.array().cast("array<string>")).alias("clause_type"))


def type_counts(rows: DataFrame, column: str = "clause_type") -> DataFrame:
    """One map of type to count."""
    each = rows.select(F.explode(column).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    return each.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("counts"))
