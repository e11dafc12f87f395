"""A corpus pipeline: from raw documents to batches for training.

Each stage takes (spark, docs, sf_dir) and works on what its predecessor kept, written as Parquet
and read again.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import langid, mixing, packing, pii, shingles, simhash
from quillmill.llm.common import bounded, materialise, table
from quillmill.llm.components import connected_components


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language learned from docs; rejected ones go."""
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))), "doc_id", "text", "lang")
    return langid.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that of the least id, of those the one of the least text hash.

    Texts are joined if the fingerprints of their five-word shingles differ in four bits at most,
    as Golay codeword keys find them, or if the shingles have a Jaccard similarity of 0.8 or more;
    the latter are found in full and verified.  Null texts are empty, and empty texts are one
    group.  Different texts of one doc_id are different documents; of rows that repeat both, one
    stays, chosen by a hash of all columns.  A null doc_id stays only where a group has no other.
    """
    node = shingles.text_node(F.col("text"))
    named = docs.select("doc_id", node.alias("_node"), "text")
    prints = simhash.near_duplicates(named, "_node", shingle=shingles.WORDS).select(F.col("doc_id").alias("node"), F.col("component_id").alias("root"))
    known = materialise(prints.distinct())
    links = known.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(shingles.shingle_links(docs, known=known))
    roots = connected_components(links).withColumnRenamed("node", "_node")
    ids = named.groupBy("doc_id", "_node").agg(F.count("*").alias("n"))
    own = materialise(ids.join(roots, "_node", "left").select("doc_id", "_node", "n", F.coalesce("root", "_node").alias("root")))
    first = own.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_node")).alias("first"))
    told = own.join(first, "root").select(F.col("doc_id").alias("_id"), F.col("_node").alias("_its"), "n", (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_node") == F.col("first._node"))).alias("stays"))
    told = materialise(told.where("not stays or n > 1"))
    same = (F.col("_node") == F.col("_its")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    rows = docs.withColumn("_node", node)
    kept = rows.join(bounded(told.select("_id", "_its"), 200_000), same, "left_anti").select(*docs.columns)
    twice = told.where("stays")
    if twice.isEmpty():
        return kept
    again = rows.join(bounded(twice.select("_id", "_its"), 200_000), same, "left_semi")
    one = again.groupBy("doc_id", "_node").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("one")).select("one.*")
    return kept.unionByName(one)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and n_chars counted anew."""
    return pii.mask_texts(docs, "text", "n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and slot of each document."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language identification", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

#: Language models and the field have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
