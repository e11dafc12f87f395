"""Queries over the tables."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.numerals import cn_to_int, expand_articles, int_to_cn, let, span_bounds
from ..operators import blocks, complete, extract, link, merge, pages, presence, rawinput, segment, vector
from ..streaming import incremental
from .registry import query, table

# --- identities and projections ---


@query("""
select doc_id, b || '-' || substr(sha1(b), 1, 8) as chunk_id, 'TPL-' || substr(sha1(source || '|' || text), 1, 12) as doc_key
from (select *, 'DOC-' || doc_id || '#第' || (doc_id % 90 + 1) || '条#' || lpad((doc_id % 1200)::varchar, greatest(3, length((doc_id % 1200)::varchar))::integer, '0') as b from documents)
""")
def chunk_identity_sha1(spark, sf):
    d = table(spark, sf, "documents")
    span = F.concat(F.lit("第"), (F.col("doc_id") % 90 + 1).cast("string"), F.lit("条"))
    return d.select("doc_id", tx.chunk_id(F.concat(F.lit("DOC-"), F.col("doc_id").cast("string")), span, F.col("doc_id") % 1200).alias("chunk_id"), tx.document_id("TPL", F.col("source"), F.col("text")).alias("doc_key"))


@query("select doc_id, 'md5:' || md5(text) as text_md5, 'md5:' || md5(doc_id || '|' || text) as chunk_md5, greatest(1, length(text) // 2)::bigint as token_count from documents")
def text_fingerprint_md5(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", tx.fingerprint(F.col("text")).alias("text_md5"), tx.fingerprint(F.col("doc_id").cast("string"), F.col("text")).alias("chunk_md5"), tx.estimated_tokens(F.col("text")).alias("token_count"))


@query(r"""
select doc_id, md5(trim(regexp_replace(text, '[ \t\n\r\f]+', ' ', 'g'))) as squeezed,
       md5(trim(regexp_replace(regexp_replace(regexp_replace(text, '[ \r\f\t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g'))) as statute
from documents
""")
def normalize_text(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.md5(tx.squeeze(F.col("text"))).alias("squeezed"), F.md5(tx.normalize_statute(F.col("text"))).alias("statute"))


@query("""
select conv_id, turn, coalesce(nullif(case when role = 'system' then '' else role end, ''), nullif(case when turn > 2 then 'later' end, ''), '') as filled,
       substr(coalesce(text, ''), 1, 64) as text_64, length(substr(coalesce(text, ''), 1, 64))::bigint as n from conversations
""")
def default_fill_projection(spark, sf):
    c = table(spark, sf, "conversations")
    role = F.when(F.col("role") == "system", "").otherwise(F.col("role"))
    cut = tx.clamp(F.col("text"), 64)
    return c.select("conv_id", "turn", tx.first_filled(role, F.when(F.col("turn") > 2, "later")).alias("filled"), cut.alias("text_64"), F.length(cut).cast("long").alias("n"))


@query("""
select doc_id, case when trim(source) <> '' then '【问题】' || trim(source) || chr(10) else '' end || '【解答】' || trim(lang) as content, regexp_replace(source || '/' || lang || '?', '[/?]+', '_', 'g') as safe_name from documents
""")
def tagged_content(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", tx.tagged(("【问题】", F.col("source")), ("【补充说明】", F.lit("")), ("【解答】", F.col("lang"))).alias("content"), tx.file_name(F.concat_ws("", "source", F.lit("/"), "lang", F.lit("?"))).alias("safe_name"))


# --- changes and merges ---


def _existing(d):
    changed = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" x"))).otherwise(F.col("text"))
    sha = F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.sha1(changed))
    return d.where("doc_id % 2 = 0").select(F.col("doc_id").alias("chunk_id"), changed.alias("text"), sha.alias("text_sha1"))


@query("""
with old as (select doc_id, case when doc_id % 5 = 0 then text || ' x' else text end as t from documents where doc_id % 2 = 0),
o as (select *, case when doc_id % 3 = 0 then null else sha1(t) end as sha from old)
select case when o.doc_id is null then 'NEW' when coalesce(o.sha, '') = '' then (case when o.t is not distinct from d.text then 'SAME' else 'CHANGED' end)
            when o.sha = sha1(d.text) then 'SAME' else 'CHANGED' end as status,
       count(*)::bigint as n, sum(length(d.text))::bigint as total_chars
from documents d left join o on o.doc_id = d.doc_id group by 1
""")
def incremental_change_status(spark, sf):
    d = table(spark, sf, "documents")
    found = merge.change_status(d.select(F.col("doc_id").alias("chunk_id"), "text"), _existing(d))
    return found.groupBy("status").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("total_chars"))


@query("""
with o as (select o_custkey k, max(o_orderkey) as created, max(o_totalprice) as top, list(distinct o_orderpriority) as tags from orders where o_orderkey % 3 <> 0 group by 1),
n as (select o_custkey k, max(o_orderkey) as created, max(o_totalprice) as top, list(distinct o_orderpriority) as tags from orders where o_orderkey % 3 <> 1 group by 1)
select coalesce(o.k, n.k) as cust, coalesce(o.created, n.created) as created, case when o.top is null then n.top when n.top is null then o.top else greatest(o.top, n.top) end as top,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(o.tags, []), coalesce(n.tags, [])))), ',') as tags, case when n.k is not null then 'new' else 'old' end as state
from o full join n on o.k = n.k
""")
def merge_upsert(spark, sf):
    o = table(spark, sf, "orders")

    def side(where, state):
        return o.where(where).groupBy(F.col("o_custkey").alias("cust")).agg(F.max("o_orderkey").alias("created"), F.max("o_totalprice").alias("top"), F.collect_set("o_orderpriority").alias("tags")).withColumn("state", F.lit(state))

    got = merge.merge_upsert(side("o_orderkey % 3 <> 0", "old"), side("o_orderkey % 3 <> 1", "new"), ["cust"], {"created": "set_on_insert", "top": "max", "tags": "add_to_set"})
    return got.withColumn("tags", F.array_join("tags", ","))


@query("""
select o_orderkey, 'kept' as how from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 40)
union all select o_orderkey, 'chosen' from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0)
""")
def resume_anti_join(spark, sf):
    o, i = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    done = i.where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    chosen = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    kept = merge.not_done(o, done, "o_orderkey").select("o_orderkey", F.lit("kept").alias("how"))
    return kept.unionByName(merge.restricted(o, chosen, "o_custkey").select("o_orderkey", F.lit("chosen").alias("how")))


@query("""
select o_orderkey, case when o_orderpriority = '1-URGENT' and o_orderdate < timestamp '1996-01-01' then 'repealed' else 'valid' end as status,
       o_orderstatus as doctype_detail, 'judgment' as doc_type from orders
""")
def conditional_validity_update(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("law_name"), F.date_format("o_orderdate", "yyyy-M-d").alias("version_date"), F.col("o_orderstatus").alias("doc_type"), F.lit("valid").alias("status"))
    got = merge.move_type(merge.conditional_update(o, "status", "repealed", merge.older_version("1-URGENT", "1996-01-01")))
    return got.select("o_orderkey", "status", "doctype_detail", "doc_type")


@query("""
select l_orderkey, l_linenumber, coalesce(o_orderpriority, 'own-' || l_returnflag) as priority, o_orderkey is not null as found
from lineitem left join (select * from orders where o_orderkey % 4 <> 0) o on o_orderkey = l_orderkey
""")
def parent_fallback_join(spark, sf):
    i = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("own-"), "l_returnflag").alias("priority"))
    o = table(spark, sf, "orders").where("o_orderkey % 4 <> 0").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("priority"), F.lit(True).alias("found"))
    got = merge.with_parent(i, o, "l_orderkey", ["priority", "found"])
    return got.select("l_orderkey", "l_linenumber", "parent.priority", F.coalesce("parent.found", F.lit(False)).alias("found"))


@query("""
select l_orderkey, l_partkey from (select l_orderkey, l_partkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) as n from lineitem) where n = 1
""")
def first_row_wins(spark, sf):
    i = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return merge.first_by_key(i, "l_orderkey", ["l_linenumber", "l_partkey"]).select("l_orderkey", "l_partkey")


@query("""
select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey % 7 <> 0 or l_orderkey not in (select l_orderkey from lineitem where l_linenumber = 1)
union all select l_orderkey, l_linenumber, -1 from lineitem where l_orderkey % 7 = 0 and l_linenumber = 1
""")
def replace_rows_by_key(spark, sf):
    i = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    new = i.where("l_orderkey % 7 = 0 and l_linenumber = 1").withColumn("l_partkey", F.lit(-1).cast("long"))
    return merge.replace_by_key(i, new, ["l_orderkey"])


@query("select l_orderkey, l_linenumber, count(*)::bigint as n from lineitem group by 1, 2 having count(*) > 1")
def unique_key_violations(spark, sf):
    return merge.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- numerals ---


@query("select p_partkey, (p_partkey % 10000)::bigint as back from part")
def cn_numeral_roundtrip(spark, sf):
    p = blocks.spread(table(spark, sf, "part").select("p_partkey"), "p_partkey")
    return p.select("p_partkey", cn_to_int(int_to_cn(F.col("p_partkey") % 10000)).alias("back"))


@query("select p_partkey, array_to_string(range(p_partkey % 300 + 1, p_partkey % 300 + p_size + 2), ',') as articles, (p_partkey % 300 + 1)::bigint as l, (p_partkey % 300 + 1 + p_size)::bigint as r from part")
def article_expand(spark, sf):
    a = F.col("p_partkey") % 300 + 1
    b = a + F.col("p_size")
    span = F.concat(F.lit("第"), int_to_cn(a), F.lit("条~第"), int_to_cn(b), F.lit("条"))
    p = blocks.spread(table(spark, sf, "part").select("p_partkey", "p_size"), "p_partkey")
    read = let(span, lambda s: F.struct(F.array_join(expand_articles(s).cast("array<string>"), ",").alias("articles"), span_bounds(s).alias("s")))
    return p.select("p_partkey", F.explode(F.array(read)).alias("x")).select("p_partkey", "x.articles", "x.s.l", "x.s.r")  # explode: read once


# --- citation joins ---


def _targets(part):
    a = F.col("p_partkey") % 50
    return part.select(
        F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("chunk_id"),
        F.when(F.col("p_partkey") % 9 == 0, "guide").otherwise("statute").alias("doc_type"),
        F.concat(F.lit("《中华人民共和国 "), "p_brand", F.lit("》")).alias("law_name"),
        F.array(F.concat(F.lit("S"), F.col("p_size").cast("string"))).alias("law_alias"),
        F.concat(a.cast("string"), F.lit("~第"), (a + F.col("p_size") % 4).cast("string"), F.lit("条")).alias("article_no"),
    )


def _cited(orders):
    k = F.col("o_orderkey")
    name = F.when(k % 4 == 0, F.concat(F.lit("S"), (k % 50).cast("string"))).when(k % 4 == 1, F.concat(F.lit("#"), (k % 60).cast("string"))).otherwise(F.concat(F.lit("Brand#"), (k % 60).cast("string")))
    return orders.select(k.cast("string").alias("chunk_id"), name.alias("law_norm"), (k % 53).alias("article"))


_CITED_SQL = """
t as (select 'C' || p_partkey as to_chunk, p_brand as name, 'S' || p_size as alias, p_partkey % 50 as l, p_partkey % 50 + p_size % 4 as r from part where p_partkey % 9 <> 0),
c as (select o_orderkey::varchar as from_chunk, o_orderkey % 53 as a,
             case when o_orderkey % 4 = 0 then 'S' || o_orderkey % 50 when o_orderkey % 4 = 1 then '#' || o_orderkey % 60 else 'Brand#' || o_orderkey % 60 end as law_norm from orders)
"""


@query(f"with {_CITED_SQL} select distinct from_chunk, to_chunk, 'cites' as edge from c join t on (c.law_norm = t.name or ends_with(t.name, c.law_norm) or c.law_norm = t.alias) and a between l and r")
def citation_range_join(spark, sf):
    return link.cite_edges(_cited(table(spark, sf, "orders")), _targets(table(spark, sf, "part")))[0]


@query(f"with {_CITED_SQL} select law_norm, count(*)::bigint as n from c where not exists (select 1 from t where (c.law_norm = t.name or ends_with(t.name, c.law_norm) or c.law_norm = t.alias) and a between l and r) group by 1 order by n desc, law_norm limit 20")
def missing_law_topk(spark, sf):
    return link.top_misses(link.cite_edges(_cited(table(spark, sf, "orders")), _targets(table(spark, sf, "part")))[1])


@query("""
with m as (select o_orderkey as from_doc, 'L' || o_custkey % 40 as law_norm, list(distinct l_linenumber::bigint) as arts from orders join lineitem on l_orderkey = o_orderkey group by 1, 2),
t as (select p_partkey, 'L' || p_partkey % 45 as name, range(1, p_size % 6 + 1) as arts, p_type as version from part)
select from_doc, law_norm, to_doc from (
  select from_doc, law_norm, p_partkey as to_doc, row_number() over (partition by from_doc, law_norm order by len(list_intersect(m.arts, coalesce(t.arts, []))) desc, version desc, p_partkey) as n
  from m left join t on law_norm = name) where n = 1
""")
def best_candidate_argmax(spark, sf):
    o, i, p = table(spark, sf, "orders"), table(spark, sf, "lineitem"), table(spark, sf, "part")
    m = o.join(i, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_orderkey").alias("doc_id"), F.concat(F.lit("L"), (F.col("o_custkey") % 40).cast("string")).alias("law_norm")).agg(F.collect_set(F.col("l_linenumber").cast("long")).alias("articles"))
    index = p.select(F.concat(F.lit("L"), (F.col("p_partkey") % 45).cast("string")).alias("name"), F.col("p_partkey").alias("doc_id"), F.lit(False).alias("by_alias"))
    n = F.col("p_size").cast("long") % 6
    arts = F.when(n > 0, F.sequence(F.lit(1).cast("long"), F.greatest(n, F.lit(1).cast("long")))).otherwise(F.array().cast("array<bigint>"))
    docs = p.select(F.col("p_partkey").alias("doc_id"), arts.alias("doc_articles"), F.col("p_type").alias("version"))
    return link.best_target(m.withColumn("law_raw", F.col("law_norm")), index, docs).select("from_doc", "law_norm", "to_doc")


@query("""
select l_suppkey as from_doc, l_partkey % 20 as to_doc, array_to_string(list_sort(list(distinct l_linenumber)), ',') as articles, count(*)::bigint as n, strftime(max(l_shipdate), '%Y-%m-%d') as last from lineitem group by 1, 2
""")
def edge_set_union(spark, sf):
    i = table(spark, sf, "lineitem")
    return i.groupBy(F.col("l_suppkey").alias("from_doc"), (F.col("l_partkey") % 20).alias("to_doc")).agg(F.array_join(F.array_sort(F.collect_set("l_linenumber")).cast("array<string>"), ",").alias("articles"), F.count("*").alias("n"), F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("last"))


# --- vectors ---

_QUERY_SQL = "(select vec_id as query_id, embedding as query from embeddings where vec_id % 50 = 0)"


def _queries(e):
    return e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))


def _knn_sql(where: str) -> str:
    return f"""
select query_id, vec_id, score, rank::integer as rank from (select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id) as rank from (
  select query_id, vec_id, round(list_inner_product(embedding::double[], query::double[]), 6) as score from embeddings, {_QUERY_SQL} {where})) where rank <= 8"""


@query(_knn_sql(""))
def vector_topk_ip(spark, sf):
    e = table(spark, sf, "embeddings")
    return vector.top_k(e, _queries(e))


@query(_knn_sql("where label in (1, 3, 5)"))
def filtered_knn(spark, sf):
    e = table(spark, sf, "embeddings")
    return vector.top_k(e, _queries(e), where=F.col("label").isin(1, 3, 5))


@query("""
with m as (select label, i, avg(embedding[i]::double) as x from embeddings, range(1, 65) r(i) group by 1, 2),
c as (select label, list(x order by i) as c, sqrt(sum(x * x)) as n from m group by 1),
s as (select vec_id, c.label as l, round(list_inner_product(embedding::double[], list_transform(c, lambda v: v / n)), 6) as score from embeddings, c)
select vec_id, case when score >= 0.4 then l::varchar else 'uncertain' end as vector_label, score as vector_score
from (select *, row_number() over (partition by vec_id order by score desc, l) as r from s) where r = 1
""")
def label_centroid_assign(spark, sf):
    e = table(spark, sf, "embeddings")
    return vector.nearest_centroid(e, vector.centroids(e), 0.4)


@query(f"""
with h as ({_knn_sql("").strip()})
select round(avg(hit), 6) as hit_rate, count(*)::bigint as queries from (
  select query_id, max(case when e.label = q.label then 1 else 0 end) as hit from h join embeddings e using (vec_id) join embeddings q on q.vec_id = query_id group by 1)
""")
def hit_at_k(spark, sf):
    e = table(spark, sf, "embeddings")
    hits = vector.top_k(e, _queries(e)).join(e.select("vec_id", F.concat(F.lit("label "), F.col("label").cast("string")).alias("said")), "vec_id")
    want = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.concat(F.lit("^label "), F.col("label").cast("string"), F.lit("$")).alias("must_match"))
    return vector.hit_at_k(hits, want).withColumn("hit_rate", F.round("hit_rate", 6))


@query()
def ivf_knn(spark, sf):
    e = table(spark, sf, "embeddings")
    ivf = vector.Inverted().fit(e)
    return ivf.search(ivf.index(e), _queries(e))


@query()
def hash_embedding(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return vector.embed(d, "text", vector.hash_embedder(32)).drop("text")


# --- segmentation ---


@query(r"""
with l as (select doc_id, generate_subscripts(ls, 1) - 1 as n, unnest(ls) as line from (select doc_id, string_split(text, chr(10)) as ls from documents)),
g as (select *, sum(case when regexp_matches(line, '^[A-Z]') and length(line) < 60 then 1 else 0 end) over (partition by doc_id order by n) as grp from l)
select doc_id, grp::bigint as grp, count(*)::bigint as n_lines, md5(string_agg(line, chr(10) order by n)) as text_md5 from g group by 1, 2
""")
def heading_groups(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    head = (F.col("line").rlike("^[A-Z]") & (F.length("line") < 60)).cast("int")
    g = lines.withColumn("grp", F.sum(head).over(Window.partitionBy("doc_id").orderBy("n")))
    return g.groupBy("doc_id", "grp").agg(F.count("*").alias("n_lines"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda s: s["line"]), "\n")).alias("text_md5"))


@query()
def sentence_window_chunks(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.lit(0).alias("seq"), F.lit("正文").alias("section"), F.regexp_replace("text", r"[.] ", "。").alias("text"))
    return segment.section_chunks(d)


@query()
def pack_chunks(spark, sf):
    line = F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.lit("第"), (i + 1).cast("string"), F.lit("条 "), x))
    return segment.statute_chunks(table(spark, sf, "documents").select("doc_id", F.array_join(line, "\n").alias("text")))


# --- texts put together ---


@query("select conv_id, string_agg(text, chr(10) || chr(10) order by turn) as text, count(*)::bigint as n from conversations where trim(text) <> '' group by 1")
def ordered_concat(spark, sf):
    return rawinput.ordered_concat(table(spark, sf, "conversations"), "conv_id", ["turn"])


@query("""
with w as (select *, coalesce(sum(length(text) + 2) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as before from conversations where trim(text) <> '')
select conv_id, string_agg(case when before + length(text) + 2 <= 500 then text else substr(text, 1, (500 - before)::int) end, chr(10) || chr(10) order by turn) as text, count(*)::bigint as n from w where before < 500 group by 1
""")
def budgeted_concat(spark, sf):
    return rawinput.budgeted_concat(table(spark, sf, "conversations"), "conv_id", ["turn"], 500)


@query("""
with p as (select *, coalesce(last_value(case when role = 'assistant' then 'p' || turn end ignore nulls) over (partition by conv_id order by turn), 'p1') as part from conversations),
f as (select conv_id, part, lead(part) over (partition by conv_id order by min(turn)) as next from p group by 1, 2),
t as (select p.*, next, row_number() over (partition by p.conv_id, p.part order by turn desc) as r from p join f on f.conv_id = p.conv_id and f.part = p.part)
select conv_id, turn, part, false as overlapped from p union all select conv_id, turn, next, true from t where r <= 1 and next is not null
""")
def three_part_split(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    marker = F.when(F.col("role") == "assistant", F.concat(F.lit("p"), F.col("turn").cast("string")))
    return rawinput.parts(c, "conv_id", ["turn"], marker, overlap=1).select("conv_id", "turn", "part", "overlapped")


# --- classification and presence ---

_LATIN = {"law": "that this with", "lease": "the ou", "nda": "qui est", "sale": "der die und"}


def _latin_sql() -> str:
    def score(words: str) -> str:
        return " + ".join(f"(case when contains(lower(source), '{w}') then 2 else 0 end + least(len(string_split(b, '{w}')) - 1, 2))" for w in words.split())

    return ", ".join(f"({score(ws)})::bigint as {k}" for k, ws in _LATIN.items())


@query(f"""
with b as (select doc_id, source, lower(text) as b from documents), s as (select doc_id, {_latin_sql()} from b),
u as (select doc_id, unnest(['law', 'lease', 'nda', 'sale']) as k, unnest([law, lease, nda, sale]) as s from s),
r as (select *, row_number() over (partition by doc_id order by s desc, k) as r, lead(s) over (partition by doc_id order by s desc, k) as nxt from u)
select doc_id, case when s >= 3 and s - nxt >= 1 then k else 'uncertain' end as label, s as best from r where r = 1
""")
def keyword_classify(spark, sf):
    d = table(spark, sf, "documents")
    got = extract.classify(d, _LATIN, "source", "text", chars=None, gates={})
    return got.select("doc_id", "label", F.array_max(F.map_values("scores")).alias("best"))


@query("""
with c as (select o_orderkey, case o_custkey % 3 when 0 then 'nda' when 1 then 'lease' else 'labor' end as t from orders),
i as (select * from (values ('nda', 'term', true), ('nda', 'survival', true), ('lease', 'term', true), ('lease', 'renewal', false), ('labor', 'training', false)) v(t, id, required)),
h as (select l_orderkey, case l_partkey % 4 when 0 then 'term' when 1 then 'survival' when 2 then 'training' else 'other' end as id, l_linenumber from lineitem)
select o_orderkey::varchar as doc_id, c.t as contract_type, i.id, i.required, count(l_linenumber) > 0 as present, coalesce(string_agg(l_linenumber::varchar, ',' order by l_linenumber), '') as sources
from c join i on i.t = c.t left join h on h.l_orderkey = o_orderkey and h.id = i.id group by all
""")
def presence_matrix(spark, sf):
    kind = lambda c, *xs: F.when(c == 0, xs[0]).when(c == 1, xs[1]).otherwise(xs[2])
    docs = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("doc_id"), kind(F.col("o_custkey") % 3, "nda", "lease", "labor").alias("contract_type"))
    p = F.col("l_partkey") % 4
    tag = F.when(p == 0, "term").when(p == 1, "survival").when(p == 2, "training").otherwise("other")
    clauses = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("doc_id"), F.col("l_linenumber").alias("order"), F.col("l_linenumber").cast("string").alias("chunk_id"), F.array(tag).alias("clause_type"))
    items = presence.item_rows(spark, {"nda": "term 期限 *\nsurvival 存续 *", "lease": "term 期限 *\nrenewal 续租", "labor": "training 培训"})
    return presence.presence_matrix(docs, clauses, items).withColumn("sources", F.array_join("sources", ","))


@query("""
select p_partkey, array_to_string(list_filter([case when p_size not between 1 and 40 then 'size' end, case when p_brand not in ('Brand#11', 'Brand#22') then 'brand' end, case when trim(p_name) = '' then 'name' end], lambda x: x is not null), ',') as wrong from part
""")
def graph_validate(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("size"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"))
    e = presence.errors(presence.between("size", 1, 40), presence.one_of("brand", ["Brand#11", "Brand#22"]), presence.required("name"))
    return p.select("p_partkey", F.array_join(F.transform(e, lambda x: x["loc"]), ",").alias("wrong"))


@query("""
select event_id, coalesce((props->>'$.k')::bigint, -1) as k, coalesce(nullif(case when event_id % 3 = 0 then '' else event_type end, ''), 'old', 'd') as name, coalesce(case when event_id % 2 = 0 then value end, user_id::double) as v from events
""")
def deep_merge_defaults(spark, sf):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("name string, inner struct<k:bigint,v:double>")
    e = table(spark, sf, "events")
    new = F.struct(F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")).alias("name"), F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("v")).alias("inner"))
    old = F.struct(F.lit("old").alias("name"), F.struct(F.lit(None).cast("bigint").alias("k"), F.col("user_id").cast("double").alias("v")).alias("inner"))
    default = F.struct(F.lit("d").alias("name"), F.struct(F.lit(-1).cast("bigint").alias("k"), F.lit(0.0).alias("v")).alias("inner"))
    return e.select("event_id", presence.deep_merge(schema, new, old, default).alias("m")).select("event_id", "m.inner.k", "m.name", "m.inner.v")


@query("select k, n from (select p_brand as k, count(*)::bigint as n from part group by 1)")
def clause_type_counts(spark, sf):
    p = table(spark, sf, "part").select(F.array("p_brand").alias("clause_type"))
    return rawinput.type_counts(p).select(F.explode("counts").alias("k", "n"))


# --- pages ---


@query(r"""
select page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[ \t\r\n\f]+', ' ', 'g')) as text from pages
""")
def html_page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", pages.markup_text(F.col("html")).alias("text"))


@query("""
with t as (select l_orderkey % 50 as page, l_orderkey * 10 + l_linenumber as id, l_extendedprice % 1000 as x, l_quantity * 20 as y from lineitem where l_linenumber = 1),
b as (select l_orderkey % 50 as page, l_orderkey * 10 + l_linenumber as id, l_extendedprice % 1000 as x, l_quantity * 20 as y from lineitem where l_linenumber = 2)
select t.page, t.id as tick, arg_min(b.id, (sqrt(pow(b.x - t.x, 2) + pow(b.y - t.y, 2)), b.id)) as box from t join b on b.page = t.page and sqrt(pow(b.x - t.x, 2) + pow(b.y - t.y, 2)) < 25 group by 1, 2
""")
def nearest_box_join(spark, sf):
    i = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 50).alias("page"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_extendedprice") % 1000).alias("x"), (F.col("l_quantity") * 20).alias("y"), "l_linenumber")
    return pages.nearest_within(i.where("l_linenumber = 1"), i.where("l_linenumber = 2"))


# --- model calls ---


def _echo(prompt: str) -> str:
    """A stand-in for a model: its first answer lacks a field, the repaired one has it."""
    text = prompt.split("\n\nRepair:")[0]
    if "Repair:" in prompt:
        return '```json\n{"title": "' + re.sub(r'[\\"\n]', " ", text[:20]) + '", "chars": ' + str(len(text)) + "}\n```"
    return 'Here: {"chars": ' + str(len(text)) + "}"


def _titled(found: dict) -> list[str]:
    return [] if "title" in found else ["title: field required"]


@query("select doc_id::varchar as doc_id, length(text)::bigint as chars, 2::bigint as calls, 0::bigint as n_errors from documents")
def llm_stub_extract_repair(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    got = complete.extract_graphs(d, lambda: complete.Paced(_echo), lambda t: t, _titled)
    return got.select("doc_id", F.get_json_object("payload", "$.chars").cast("long").alias("chars"), "calls", F.size("errors").cast("long").alias("n_errors"))


# --- extensions: what the tables offer beyond ---


@query("select date_trunc('hour', ts)::varchar as start, event_type, count(*)::bigint as n, round(sum(value), 4) as total from events group by 1, 2")
def ext_stream_windowed_counts(spark, sf):
    kind = table(spark, sf, "events").schema
    stream = incremental.follow(spark, f"{sf}/events.parquet*", kind)
    name = f"ext_{abs(hash(sf)) % 10**8}_{spark.sparkContext.startTime}"
    out = incremental.windowed_counts(stream)
    q = out.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).option("checkpointLocation", _checkpoint(spark)).start()
    q.awaitTermination()
    return spark.table(name).select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def _checkpoint(spark) -> str:
    import uuid

    at = spark.conf.get("spark.checkpoint.dir", None)
    return f"{at.rstrip('/')}/stream-{uuid.uuid4().hex}" if at else tempfile.mkdtemp()


@query("select l_returnflag, l_linestatus, count(*)::bigint as n, round(sum(l_quantity), 2) as qty from lineitem group by cube (l_returnflag, l_linestatus)")
def ext_cube(spark, sf):
    return table(spark, sf, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("""
with g as (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) > interval 30 minute then 1 else 0 end as cut from events),
s as (select *, sum(cut) over (partition by user_id order by ts, event_id) as s from g)
select user_id, s::bigint as session, count(*)::bigint as n from s group by 1, 2
""")
def ext_sessions(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    cut = F.when(F.col("ts").cast("double") - F.lag("ts").over(w).cast("double") > 1800, 1).otherwise(0)
    return e.withColumn("cut", cut).withColumn("session", F.sum("cut").over(w)).groupBy("user_id", "session").agg(F.count("*").alias("n"))
