"""Queries of record operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extract, records
from .registry import query, rows_sql, table


@query("""
select conv_id, coalesce(arg_min(role, turn), '') as role, coalesce(arg_min(text, turn), '') as text from conversations where conv_id is not null group by conv_id
""")
def doc_records(spark, sf):
    return records.doc_records(table(spark, sf, "conversations"), ["role", "text"], key="conv_id", order="turn")


@query("select p_partkey, p_type from part where regexp_matches(p_type, '(MO|MY)$')")
def kind_filter(spark, sf):
    return records.of_kind(table(spark, sf, "part"), "(MO|MY)$", "p_type").select("p_partkey", "p_type")


@query("""
(select 'first' as way, o_orderkey, o_totalprice from orders order by o_orderkey limit 25)
union all select 'one', o_orderkey, o_totalprice from orders where o_orderkey = 7
""")
def pick_documents(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    ways = (("first", records.pick(o, "o_orderkey", limit=25)), ("one", records.pick(o, "o_orderkey", one=7)))
    first, one = (d.select(F.lit(w).alias("way"), "o_orderkey", "o_totalprice") for w, d in ways)
    return first.unionByName(one)


@query("""
select o_orderkey, o_orderpriority, count(*)::bigint as n, sum(l_linenumber)::bigint as numbers
from orders join lineitem on o_orderkey = l_orderkey and o_orderstatus = l_linestatus group by all
""")
def document_chunks(spark, sf):
    docs = table(spark, sf, "orders").select(F.col("o_orderkey"), F.col("o_orderstatus").alias("status"), "o_orderpriority")
    chunks = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("status"), "l_linenumber")
    both = records.with_chunks(docs, chunks, ("o_orderkey", "status"))
    return both.groupBy("o_orderkey", "o_orderpriority").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("numbers"))


@query("select (select count(*) from orders) as citations, count(*) as edges, count(distinct (l_suppkey, l_partkey)) as distinct_edges from lineitem")
def edge_counts(spark, sf):
    edges = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("from_chunk"), F.col("l_partkey").alias("to_chunk"))
    return records.edge_counts(table(spark, sf, "orders"), edges)


@query("select doc_id, substr(case when trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' then source else source || chr(10) || chr(10) || trim(text, ' ' || chr(9) || chr(10) || chr(13)) end, 1, 512) as text from documents")
def embedding_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", records.embedding_text(F.col("source"), F.col("text"), 512).alias("text"))


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as at from events")
def iso_times(spark, sf):
    return table(spark, sf, "events").select("event_id", records.iso_utc(F.col("ts")).alias("at"))


_PATHS = [("in/lease/a.txt", "lease"), ("in/NDA/b.docx", "nda"), ("c.txt", "buy_sell"), ("in\\labor\\d.txt", "labor"), ("in/other/e.txt", "buy_sell"), (None, "buy_sell"), ("software/x/f.txt", "buy_sell")]


@query(rows_sql("path string, kind string", _PATHS))
def contract_folder(spark, sf):
    d = spark.createDataFrame([x[:1] for x in _PATHS], "path string")
    return d.select("path", records.business_type(F.col("path")).alias("kind"))


_CATEGORIES = [("刑事", "判决书", "刑事"), (None, "民事裁定书", "民事"), ("行政", "民事判决书", "民事"), ("", "赔偿决定书", "国家赔偿"), ("国家赔偿", "", "国家赔偿"), ("", "通知书", "刑事"), ("执行", "裁定书", "执行")]


@query(rows_sql("system string, doc_type string, category string", _CATEGORIES))
def judgment_category(spark, sf):
    d = spark.createDataFrame([x[:2] for x in _CATEGORIES], "system string, doc_type string")
    return d.select("system", "doc_type", records.doc_category(F.col("system"), F.col("doc_type")).alias("category"))


_HEADS = [("某法院执行裁定书 行政", "执行"), ("赔偿决定书 行政", "国家赔偿"), ("行政判决书", "行政"), ("刑事附带民事判决书", "刑事"), ("调解书", "民事"), (None, "民事"), ("民" * 1000 + "执行", "民事")]


@query(rows_sql("text string, system string", _HEADS))
def judgment_system(spark, sf):
    d = spark.createDataFrame([x[:1] for x in _HEADS], "text string")
    return d.select("text", records.system_of_text(F.col("text")).alias("system"))


_DATED = [
    ("本院于二〇二〇年三月一日受理。判决如下。二〇二一年五月六日", "2021-05-06"),
    ("二〇二〇年三月一日作出判决。" + "另" * 60 + "二〇二二年一月二日", "2020-03-01"),
    ("二〇二〇年三月一日" + "另" * 60 + "二〇二二年一月二日" + "等" * 30, "2022-01-02"),
    ("二〇二〇年十三月一日判决", None),
    (None, None),
]


@query(rows_sql("text string, decided string", _DATED))
def judgment_dates(spark, sf):
    d = spark.createDataFrame([x[:1] for x in _DATED], "text string")
    return d.select("text", extract.judgment_date(F.col("text")).alias("decided"))


_AMENDED = [("（一）《甲条例》 将第三条修改为某某。 二、修改《乙条例》", "《甲条例》《乙条例》")]


@query(rows_sql("text string, laws string", _AMENDED))
def amended_in_order(spark, sf):
    d = spark.createDataFrame([x[:1] for x in _AMENDED], "text string")
    return d.select("text", F.array_join(extract.amended_laws(F.col("text")), "").alias("laws"))
