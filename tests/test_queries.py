"""Every registered query against its SQL, and those without SQL against brute force."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

from quillmill.operators import vector
from quillmill.plans import files, fixtures, judgments, records, tables  # noqa: F401
from quillmill.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def as_rows(frame):
    columns = sorted(frame.columns)
    plain = frame[columns].map(lambda v: v.tolist() if hasattr(v, "tolist") else v)
    return columns, sorted(plain.astype(str).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, sf, db, name):
    assert as_rows(QUERIES[name](spark, sf).toPandas()) == as_rows(db.execute(ORACLES[name]).df())


def test_queries_without_sql_are_known():
    assert set(QUERIES) - set(ORACLES) == {"ivf_knn", "hash_embedding", "sentence_window_chunks", "pack_chunks"}


def test_inverted_file_recall(spark, sf):
    exact = {(r.query_id, r.vec_id) for r in QUERIES["vector_topk_ip"](spark, sf).collect()}
    found = {(r.query_id, r.vec_id) for r in QUERIES["ivf_knn"](spark, sf).collect()}
    assert len(found) == len(exact) and len(found & exact) >= 0.9 * len(exact)


def test_hash_embeddings_are_unit_vectors_of_the_text(spark, sf):
    rows = QUERIES["hash_embedding"](spark, sf).collect()
    name = next(c for c in rows[0].asDict() if c != "doc_id")
    assert all(len(r[name]) == 32 and abs(np.linalg.norm(r[name]) - 1) < 1e-5 for r in rows)
    twice = spark.createDataFrame([(1, "one text"), (2, "one text"), (3, "other words")], "doc_id long, text string")
    a, b, c = (r[name] for r in vector.embed(twice, "text", vector.hash_embedder(32)).orderBy("doc_id").collect())
    assert a == b != c


def test_windows_keep_every_sentence_in_order(spark, sf):
    texts = {r.doc_id: r.text.replace(". ", "。") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    chunks: dict[int, list] = {}
    for r in QUERIES["sentence_window_chunks"](spark, sf).collect():
        chunks.setdefault(int(r.doc_id), []).append(r)
    squeeze = lambda s: "".join(s.split())
    for doc_id, own in chunks.items():
        whole = squeeze(texts[doc_id])
        for r in own:
            for sentence in filter(None, map(squeeze, r.text.split("。"))):
                assert sentence in whole
        said = set(filter(None, (squeeze(s) for r in own for s in r.text.split("。"))))
        assert all(squeeze(s) in said for s in texts[doc_id].split("。") if squeeze(s) and "\n" not in s.strip() and not any(c in s for c in "！？；"))


def test_packed_chunks_keep_every_article(spark, sf):
    chunks: dict[int, str] = {}
    for r in QUERIES["pack_chunks"](spark, sf).collect():
        assert r.text.strip()
        chunks[int(r.doc_id)] = chunks.get(int(r.doc_id), "") + "".join(r.text.split())
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        for line in r.text.split("\n"):
            assert "".join(line.split()).lstrip("：:．.") in chunks.get(r.doc_id, "")


@pytest.mark.parametrize("name", ["article_expand", "cn_numeral_roundtrip"])
def test_dear_rows_of_one_file_are_read_by_many_tasks(spark, sf, name):
    d = QUERIES[name](spark, sf)
    each = d.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(n > 0 for n in each) > 1 and sum(each) == spark.read.parquet(f"{sf}/part.parquet").count()
