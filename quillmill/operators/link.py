"""Citations, and the graph of what cites or applies what."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import profiles
from ..functions.numerals import NUMERAL, cn_to_int, expand_articles, span_bounds
from ..functions.text import bare_name, law_name, law_title, text

CITATION = rf"《\s*([^》]+?)\s*》第({NUMERAL}+)条"


#: Articles of the longest span that is taken article by article.
SHORT = 16


_NUMERALS = re.compile(f"^{NUMERAL}+")


def citations(chunks: DataFrame, id_col: str = "chunk_id", text_col: str = "text") -> DataFrame:
    """(id, law_raw, article_raw, law_norm, article) for each 《…》第N条 of a text."""
    found = F.arrays_zip(*[F.regexp_extract_all(text(F.col(text_col)), F.lit(CITATION), F.lit(i)).alias(n) for i, n in ((1, "law_raw"), (2, "article_raw"))])
    rows = chunks.select(F.col(id_col), F.explode(found).alias("c")).select(id_col, "c.*")
    return rows.withColumn("law_norm", law_name(F.col("law_raw"), deep=False)).withColumn("article", cn_to_int(F.col("article_raw")))


#: Distinct pairs of a name and an article that are broadcast; more are merged.
PAIRS = 20_000


def _spans(targets: DataFrame) -> DataFrame:
    """(chunk_id, name, aliases, l, r, level) of the targets with a span of articles."""
    t = targets.select("chunk_id", law_name(F.col("law_name"), deep=False).alias("name"), F.transform(F.coalesce("law_alias", F.array().cast("array<string>")), lambda a: law_name(a, deep=False)).alias("aliases"), span_bounds(F.col("article_no")).alias("s"))
    far = F.col("s.r") - F.col("s.l")
    level = F.when(far < SHORT, 0).otherwise(F.length(F.bin(far)))
    return t.where("s.l is not null and s.l <= s.r").select("chunk_id", "name", "aliases", "s.l", "s.r", level.alias("level"))


def target_keys(targets: DataFrame, suffixes: int = 1, names: DataFrame | None = None) -> DataFrame:
    """(chunk_id, key, level, slot, l, r) under which targets are cited for the articles l to r.

    Keys are the name, each suffix of it of at least `suffixes` characters, and the aliases; of these
    only what is in names (key), if given.  A span lies in slots of 2**level articles: up to SHORT
    articles in one slot each, a longer one in two slots at most, however long it is; so a range match
    becomes an equi-join on key, level and slot.
    """
    ends = F.when(F.length("name") >= suffixes, F.transform(F.sequence(F.lit(1), F.length("name") - suffixes + 1), lambda i: F.substring(F.col("name"), i, F.length("name")))).otherwise(F.array("name"))
    keys = F.filter(F.array_distinct(F.concat(ends, "aliases")), lambda k: k != "")
    spans = _spans(targets).select("chunk_id", F.explode(keys).alias("key"), "level", "l", "r")
    if names is not None:
        spans = spans.join(names, "key", "left_semi").select("chunk_id", "key", "level", "l", "r")
    return spans.select("*", F.explode(F.sequence(_slot("l", "level"), _slot("r", "level"))).alias("slot"))


def _slot(article: str, level: str) -> Column:
    return F.call_function("shiftright", F.col(article), F.col(level))


def _matched(asked: DataFrame, targets: DataFrame, few: bool) -> DataFrame:
    """(law_norm, article, chunk_id): the targets of each of the distinct pairs of a name and an article.

    A pair looks into the levels that spans of the targets have, 64 at most, mostly one.  Keys are
    many times the targets and nothing tells the planner so; the pairs are therefore what is
    broadcast if they are few, and else both sides are merged.
    """
    way = "broadcast" if few else "merge"
    t = targets.select("chunk_id", "law_name", "law_alias", "article_no").repartition("chunk_id")
    levels = [r[0] for r in _spans(targets).select("level").distinct().collect()]  # lengths of numbers in bits
    keys = target_keys(t, names=asked.select(F.col("law_norm").alias("key")).distinct().hint(way))
    asked = asked.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    asked = asked.withColumn("slot", _slot("article", "level")).hint(way)
    on = (asked["law_norm"] == keys["key"]) & (asked["level"] == keys["level"]) & (asked["slot"] == keys["slot"]) & asked["article"].between(keys["l"], keys["r"])
    return asked.join(keys, on).select("law_norm", "article", "chunk_id")


def cite_edges(cited: DataFrame, targets: DataFrame, id_col: str = "chunk_id", types: tuple[str, ...] = profiles.TARGET_TYPES) -> tuple[DataFrame, DataFrame]:
    """(edges from_chunk, to_chunk, edge; citations without any target).

    A target answers to its name, to an end of it and to its aliases, for articles within its
    span.  Edges are as many as a name's citations times its targets, so they are made by a merge,
    and only those of chunks with several citations are shuffled to be told apart.
    """
    c = cited.where("law_norm <> ''").withColumnRenamed(id_col, "from_chunk")
    asked = c.select("law_norm", "article").distinct()
    few = asked.count() <= PAIRS
    own = targets.where(F.col("doc_type").isin(*types))
    found = _matched(asked, own, few)
    hits = found.distinct().withColumnRenamed("chunk_id", "to_chunk").hint("merge")
    by_chunk = c.where("article is not null").groupBy("from_chunk").agg(F.collect_set(F.struct("law_norm", "article")).alias("cs"))
    each = [by_chunk.where(n).select("from_chunk", F.explode("cs").alias("c")).select("from_chunk", "c.*").join(hits, ["law_norm", "article"]).select("from_chunk", "to_chunk", F.lit("cites").alias("edge")) for n in ("size(cs) = 1", "size(cs) > 1")]
    edges = each[0].unionByName(each[1].distinct())
    known = found.select("law_norm", "article").distinct().hint("broadcast" if few else "merge")  # no more than are asked
    return edges, c.join(known, ["law_norm", "article"], "left_anti").select(*c.columns)


def top_misses(missed: DataFrame, k: int = 20, by: str = "law_norm") -> DataFrame:
    return missed.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by).limit(k)


def uncitable(name: Column) -> Column:
    """Whether a normalised name is empty or of no citable law."""
    return (text(name) == "") | name.isin(*profiles.UNCITABLE_NAMES) | name.rlike("|".join(profiles.UNCITABLE))


def normative(title: Column) -> Column:
    return title.rlike(profiles.NORMATIVE) & ~title.rlike(profiles.NOT_NORMATIVE)


_L, _R, _B = "[《〈<⟪⟨]", "[》〉>⟫⟩]", r"(?:\s*(?:（[^）]*）|\([^)]*\)|\[[^\]]*\]|【[^】]*】))*"
_HEAD = rf"{_L}\s*([^》〉>⟫⟩]+?)\s*{_R}{_B}\s*第\s*({NUMERAL}+)\s*条"
SPAN = rf"{_HEAD}\s*(?:至|到|[-~－—–])\s*第\s*({NUMERAL}+)\s*条"


def statute_mentions(docs: DataFrame, id_col: str = "doc_id", statutes_col: str = "statutes") -> DataFrame:
    """(doc_id, law_norm, law_raw, articles) from an array of citation strings.

    Ranges count first and single citations only outside of them; laws of one normalised name are
    united under their longest raw name.  Titles end at the first closing mark.
    """
    each = docs.select(id_col, F.posexplode(statutes_col).alias("seq", "s"))
    s = F.coalesce("s", F.lit(""))
    every = lambda text, pattern, i: F.regexp_extract_all(text, F.lit(pattern), F.lit(i))
    spans = F.zip_with(every(s, SPAN, 1), F.zip_with(every(s, SPAN, 2), every(s, SPAN, 3), lambda a, b: F.concat(F.lit("第"), a, F.lit("条-第"), b, F.lit("条"))), lambda raw, span: F.named_struct(F.lit("raw"), raw, F.lit("arts"), expand_articles(span)))
    rest = F.regexp_replace(s, SPAN, " ")
    singles = F.zip_with(every(rest, _HEAD, 1), every(rest, _HEAD, 2), lambda raw, no: F.named_struct(F.lit("raw"), raw, F.lit("arts"), F.array(cn_to_int(no))))
    found = each.select(id_col, "seq", F.posexplode(F.concat(spans, singles)).alias("at", "m"))
    found = found.select(id_col, "seq", "at", F.trim("m.raw").alias("raw"), F.filter("m.arts", lambda a: a > 0).alias("arts")).where("size(arts) > 0")
    found = found.withColumn("law_norm", law_name(F.col("raw"))).where("law_norm <> ''")
    longest = F.max_by("raw", F.struct(F.length("raw"), -F.col("seq"), -F.col("at")))
    return found.groupBy(id_col, "law_norm").agg(longest.alias("law_raw"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("arts")))).alias("articles"))


def article_leaves(x: Any) -> list[str]:
    """Texts that name the articles of a parsed JSON value: numbers, texts, ranges by two fields, and lists and maps of these."""
    if isinstance(x, dict):
        x = {k.lower(): v for k, v in x.items()}
        if any(set(pair) <= set(x) for pair in profiles.RANGE_FIELDS):
            ends = [next((str(x[pair[side]]) for pair in profiles.RANGE_FIELDS if x.get(pair[side])), "") for side in (0, 1)]
            read = [m[0] for end in ends if (m := _NUMERALS.search(re.sub(r"[第条\s]", "", end)))]
            return ["-".join(f"第{n}条" for n in read)] if read else []
        return [leaf for v in x.values() for leaf in article_leaves(v)]
    if isinstance(x, list):
        return [leaf for v in x for leaf in article_leaves(v)]
    if isinstance(x, (int, float)):
        return [f"第{int(x)}条"] if x >= 1 else []
    return [x] if x else []


def structured_mentions(docs: DataFrame, id_col: str = "doc_id", items_col: str = "items") -> DataFrame:
    """statute_mentions() of JSON items: objects name a law and its articles, strings and what is no JSON are citations as text.

    Null and empty items, and objects without a law or an article, give no rows.
    """
    own = docs.select(F.col(id_col).cast("string").alias("id"), F.posexplode(items_col).alias("seq", "item")).where("item is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            laws, leaves, said = [], [], []
            for item in b.column(2).to_pylist():
                try:
                    x = json.loads(item)
                except ValueError:
                    x = item
                law = next((str(x[f]).strip() for f in profiles.LAW_FIELDS if x.get(f)), "") if isinstance(x, dict) else None
                laws.append(law)
                leaves.append([leaf for f in profiles.ARTICLE_FIELDS for leaf in article_leaves(x.get(f))] if isinstance(x, dict) else [])
                said.append(x if isinstance(x, str) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(laws, pa.string()), pa.array(leaves, pa.list_(pa.string())), pa.array(said, pa.string())], names=["id", "seq", "raw", "leaves", "said"])

    read = own.mapInArrow(run, "id string, seq int, raw string, leaves array<string>, said string")
    objects = read.select("id", F.col("raw").alias("law_raw"), law_name(F.col("raw")).alias("law_norm"), F.explode("leaves").alias("leaf"))
    objects = objects.select("id", "law_raw", "law_norm", expand_articles(F.col("leaf")).alias("articles"))
    texts = statute_mentions(read.where("said is not null").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "said"))), lambda x: x["said"]).alias("s")), "id", "s")
    both = objects.unionByName(texts).where("law_norm <> '' and size(articles) > 0")
    longest = F.max_by("law_raw", F.struct(F.length("law_raw"), "law_raw"))
    return both.groupBy(F.col("id").alias(id_col), "law_norm").agg(longest.alias("law_raw"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("articles")))).alias("articles"))


def mention_failures(docs: DataFrame, id_col: str = "doc_id", statutes_col: str = "statutes") -> DataFrame:
    """(entry, n): citation strings that name no article, less titles that need none."""
    s = F.trim(F.coalesce("s", F.lit("")))
    title = law_name(F.regexp_extract(s, rf"{_L}\s*(.+?)\s*{_R}", 1))
    idle = s.rlike(_L) & (uncitable(title) | s.rlike("批复|复函|答复|请示"))
    each = docs.select(F.explode(statutes_col).alias("s")).where((s != "") & ~s.rlike(_HEAD) & ~idle)
    return each.groupBy(s.alias("entry")).agg(F.count("*").alias("n"))


def target_index(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(names: name, doc_id, by_alias; docs: doc_id, articles, version)."""
    names = chunks.where("doc_id is not null")
    keys = F.array(law_title(F.col("title")), law_name(F.col("law_name")))
    own = names.select("doc_id", F.explode(keys).alias("name"), F.lit(False).alias("by_alias"))
    alias = names.select("doc_id", F.explode(F.transform("law_alias", law_title)).alias("name"), F.lit(True).alias("by_alias"))
    index = own.unionByName(alias).where("name <> ''").groupBy("name", "doc_id").agg(F.min("by_alias").alias("by_alias"))
    docs = names.groupBy("doc_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(expand_articles(F.col("article_no")))))).alias("doc_articles"), F.max(text(F.col("version_date"))).alias("version"))
    return index, docs


def best_target(mentions: DataFrame, index: DataFrame, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """mentions with to_doc: of the documents of that name the one that shares most articles, then the latest, then the least id; null for none.

    mentions are unique on document and law.  Of the candidates of one name and one set of articles
    only the best can win, so these alone are ranked, once for each law and set of articles cited.
    """
    none = F.array().cast("array<bigint>")
    m = mentions.withColumnRenamed(id_col, "from_doc").withColumn("_arts", F.array_sort(F.coalesce("articles", none)))
    asked = m.select("law_norm", "_arts").distinct()
    each = index.withColumnRenamed("doc_id", "cand").join(docs.withColumnRenamed("doc_id", "cand"), "cand", "left").withColumn("_own", F.array_sort(F.array_distinct(F.coalesce("doc_articles", none))))
    latest = each.groupBy("name", "_own", "version").agg(F.min(F.struct("cand", "by_alias")).alias("c"))
    latest = latest.groupBy("name", "_own").agg(F.max(F.struct(F.col("version").isNotNull(), "version")).alias("v"), F.max_by("c", F.struct(F.col("version").isNotNull(), "version")).alias("c"))
    hits = asked.join(latest, asked["law_norm"] == latest["name"])
    shared = F.size(F.array_intersect("_arts", "_own"))
    w = Window.partitionBy("law_norm", "_arts").orderBy(F.desc(shared), F.desc("v.version"), "c.cand")
    best = hits.withColumn("_no", F.row_number().over(w)).where("_no = 1").select("law_norm", "_arts", F.col("c.cand").alias("to_doc"), "c.by_alias")
    return m.join(best, ["law_norm", "_arts"], "left").select("from_doc", "law_norm", "law_raw", "articles", "to_doc", "by_alias")


def code_sections(chunks: DataFrame, code_doc: str, rules=profiles.SECTION_RULES) -> DataFrame:
    """(section, articles) of one code, by the part, chapter and section of its chunks."""

    def holds(part: str, chapter: str | None, either: str | None) -> Column:
        c = text(F.col("path.bian")).startswith(part)
        if chapter:
            c &= text(F.col("path.zhang")).rlike(chapter)
        if either:
            c &= text(F.col("path.zhang")).contains(either) | text(F.col("path.jie")).contains(either)
        return c

    named = F.filter(F.array(*[F.when(holds(p, c, e), F.lit(n)) for n, p, c, e in rules]), lambda x: x.isNotNull())
    each = chunks.where(F.col("doc_id") == code_doc).select(F.explode(named).alias("section"), expand_articles(F.col("article_no")).alias("a"))
    return each.groupBy("section").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("a")))).alias("section_articles"))


def latest_code(chunks: DataFrame, name: str = "民法典") -> DataFrame:
    """(doc_id): the statute of that name of the greatest version, then id."""
    c = chunks.where((F.col("doc_type") == "statute") & law_name(F.col("law_name")).contains(name))
    return c.groupBy("doc_id").agg(F.max(text(F.col("version_date"))).alias("v")).orderBy(F.desc("v"), F.desc("doc_id")).limit(1).select("doc_id")


def case_system(*fields: Column) -> Column:
    """admin, criminal or civil by hints in any of the fields."""
    said = F.concat_ws("；", *fields)
    c = F.lit("civil")
    for system, hints in reversed(profiles.SYSTEM_HINTS):
        c = F.when(said.rlike(hints), system).otherwise(c)
    return c


def apply_edges(judgments: DataFrame, chunks: DataFrame, code_doc: str | None = None, most: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, alias additions, misses) from judgments (doc_id, system, statutes) to statutes.

    Fixed routes come first, then old laws go to their section of the code, generic
    interpretations to the one of the case's system, and all others by name.  Edges are unique on
    from_doc and to_doc; a contribution of more than `most` articles adds none.  Aliases are written to
    the chunks of the articles cited, for laws found by name or routed to a section of the code.
    """
    index, docs = target_index(chunks)
    m = statute_mentions(judgments).join(judgments.select("doc_id", "system"), "doc_id").where(~uncitable(F.col("law_norm")))
    fixed = F.lit(None).cast("string")
    for phrase, doc in profiles.FIXED_ROUTES:
        fixed = F.when(F.col("law_norm").contains(phrase) | F.col("law_raw").contains(phrase), doc).otherwise(fixed)
    section = F.try_element_at(F.create_map(*[F.lit(x) for kv in profiles.CODE_SECTIONS.items() for x in kv]), F.col("law_norm")) if code_doc else F.lit(None).cast("string")
    m = m.withColumn("fixed", fixed).withColumn("section", F.when(F.col("fixed").isNull(), section))
    generic = F.col("fixed").isNull() & F.col("section").isNull() & F.col("law_norm").isin(*profiles.GENERIC_NAMES)
    m = m.withColumn("generic", generic)
    none = F.array().cast("array<bigint>")

    by_fixed = m.where("fixed is not null").select("doc_id", "law_norm", "law_raw", "articles", F.col("fixed").alias("to_doc"), F.lit(False).alias("scoped"), F.lit(False).alias("by_alias"))
    sections = code_sections(chunks, code_doc) if code_doc else None
    parts = [by_fixed]
    if sections is not None:
        s = m.where("section is not null").join(F.broadcast(sections), "section", "left")  # one row for each rule
        parts.append(s.select("doc_id", "law_norm", "law_raw", F.array_intersect("articles", F.coalesce("section_articles", none)).alias("articles"), F.lit(code_doc).alias("to_doc"), F.lit(True).alias("scoped"), F.lit(False).alias("by_alias")))
    system = F.try_element_at(F.create_map(*[F.lit(x) for k, v in profiles.LITIGATION.items() for x in (v, k)]), F.col("name"))
    named = index.where("not by_alias").withColumn("of", system).where("of is not null").join(docs, "doc_id")
    newest = named.groupBy("of").agg(F.max_by(F.struct("doc_id", "doc_articles"), F.struct("version", "doc_id")).alias("t")).select("of", F.col("t.doc_id").alias("to_doc"), "t.doc_articles")
    g = m.where("generic").join(F.broadcast(newest))  # three rows at most
    score = F.size(F.array_intersect("articles", "doc_articles")) + F.when(F.col("of") == F.col("system"), 100).otherwise(0)
    w = Window.partitionBy("doc_id", "law_norm").orderBy(F.desc("score"), "to_doc")
    g = g.withColumn("score", score).withColumn("_no", F.row_number().over(w)).where("_no = 1 and score > 0")
    parts.append(g.select("doc_id", "law_norm", "law_raw", "articles", "to_doc", F.lit(False).alias("scoped"), F.lit(False).alias("by_alias")))
    routed = parts[0]
    for p in parts[1:]:
        routed = routed.unionByName(p)
    open_ = m.join(routed.select("doc_id", "law_norm"), ["doc_id", "law_norm"], "left_anti")
    best = best_target(open_.select("doc_id", "law_norm", "law_raw", "articles"), index, docs)
    misses = best.where("to_doc is null")
    found = best.where("to_doc is not null").select(F.col("from_doc").alias("doc_id"), "law_norm", "law_raw", "articles", "to_doc", F.lit(None).cast("boolean").alias("scoped"), "by_alias")
    rows = routed.unionByName(found)
    given = F.when(F.size("articles").between(1, most), F.col("articles")).otherwise(none)
    edges = rows.withColumn("given", given).groupBy(F.col("doc_id").alias("from_doc"), "to_doc").agg(F.min_by("law_raw", "law_norm").alias("law_name_raw"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("given")))).alias("articles"))
    edges = edges.select("from_doc", "to_doc", F.lit("applies").alias("edge"), "law_name_raw", "articles")

    cleaned = bare_name(F.col("law_raw"))
    old = F.col("law_norm").isin(*profiles.CODE_SECTIONS) | cleaned.isin(*profiles.CODE_SECTIONS)
    writes = F.coalesce("scoped", F.coalesce("by_alias", F.lit(False)) | ((cleaned != "") & (cleaned != F.col("law_norm")) & ~old))
    where = chunks.select(F.col("doc_id").alias("to_doc"), "chunk_id", F.explode(expand_articles(F.col("article_no"))).alias("article"))
    named_rows = rows.where(writes).where(F.col("to_doc").isNotNull()).select("to_doc", "law_raw", F.explode("articles").alias("article"))
    aliases = named_rows.join(where, ["to_doc", "article"]).select("to_doc", "chunk_id", F.col("law_raw").alias("alias")).distinct()
    return edges, aliases, misses


def write_aliases(chunks: DataFrame, aliases: DataFrame) -> DataFrame:
    """chunks with the alias additions united into law_alias."""
    more = aliases.groupBy("chunk_id").agg(F.array_sort(F.collect_set("alias")).alias("_more"))
    none = F.array().cast("array<string>")
    return chunks.join(more, "chunk_id", "left").withColumn("law_alias", F.array_union(F.coalesce("law_alias", none), F.coalesce("_more", none))).drop("_more").select(*chunks.columns)
