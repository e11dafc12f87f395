"""Records of documents and chunks: projections, choices, joins and small derived fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import profiles
from ..functions.text import text


def doc_records(chunks: DataFrame, fields: list[str], lists: list[str] = (), key: str = "doc_id", order: str = "chunk_index") -> DataFrame:
    """One row for each document, of its first chunk by order: fields without nulls, and lists.

    Rows without a key give none.
    """
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in fields if c != key]
    filled += [F.coalesce(F.col(c), F.array().cast("array<string>")).alias(c) for c in lists]
    named = chunks.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    return named.groupBy(key).agg(F.min_by(F.struct(*filled), F.struct(F.col(order), *filled)).alias("r")).select(key, "r.*")


def of_kind(rows: DataFrame, pattern: str, col: str = "doc_type") -> DataFrame:
    """Rows whose kind holds the pattern; null is empty; an empty pattern keeps all."""
    return rows.where(text(F.col(col)).rlike(pattern)) if pattern else rows


def pick(docs: DataFrame, key: str = "doc_id", one: str | None = None, limit: int | None = None) -> DataFrame:
    """The document of one key, or the first ones in order of the key, or all."""
    if one is not None:
        return docs.where(F.col(key) == one)
    return docs if limit is None else docs.orderBy(key).limit(limit)


def with_chunks(docs: DataFrame, chunks: DataFrame, keys: tuple[str, ...] = ("doc_id", "doc_type")) -> DataFrame:
    """Documents with their chunks, by all keys; documents without a chunk are left out."""
    return docs.join(chunks, list(keys))


def edge_counts(cited: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: citations, edges, and distinct edges."""
    ends = edges.agg(F.count("*").alias("edges"), F.count_distinct(F.struct("from_chunk", "to_chunk")).alias("distinct_edges"))
    return cited.agg(F.count("*").alias("citations")).crossJoin(ends)  # one row each


def embedding_text(title: Column, body: Column, most: int = 0) -> Column:
    """Title, blank line and body, without what is empty, cut to so many characters if above 0."""
    trimmed = [F.regexp_replace(text(c), r"(?U)^\s+|\s+$", "") for c in (title, body)]
    joined = F.array_join(F.filter(F.array(*trimmed), lambda x: x != ""), "\n\n")
    return F.substring(joined, 1, most) if most > 0 else joined


def iso_utc(at: Column | None = None) -> Column:
    """A time, now by default, as ISO 8601 to seconds with Z; the session's zone must be UTC."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def business_type(path: Column) -> Column:
    """The kind of contract that the folder of a path names, buy_sell if it names none."""
    folder = F.lower(F.try_element_at(F.split(F.replace(text(path), F.lit("\\"), F.lit("/")), "/"), F.lit(-2)))
    return F.when(folder.isin(*profiles.CONTRACT_FOLDERS), folder).otherwise(profiles.CONTRACT_FOLDERS[0])


def _first_said(said: Column, kinds: tuple[tuple[str, str], ...], otherwise: str) -> Column:
    out = F.lit(otherwise)
    for pattern, kind in reversed(kinds):
        out = F.when(said.rlike(pattern), kind).otherwise(out)
    return out


def doc_category(system: Column, doc_type: Column) -> Column:
    """The category that system or kind of a document names, in the order of CATEGORIES; 刑事 for none."""
    kind = text(doc_type)
    named = _first_said(F.concat_ws("\n", text(system), kind), tuple((c, c) for c in profiles.CATEGORIES), "")
    return F.when(named != "", named).otherwise(_first_said(kind, profiles.KIND_SAYS, profiles.CATEGORIES[0]))


def system_of_text(body: Column, reach: int = 1000) -> Column:
    """The system that the head of a judgment speaks of, 民事 for none."""
    return _first_said(F.substring(text(body), 1, reach), profiles.HEAD_SAYS, "民事")
