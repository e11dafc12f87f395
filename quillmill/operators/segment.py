"""Long texts cut into articles, chunks, sections and clauses.

What depends only on lines and their order is expressed with windows inside a document; greedy
packing, which carries state from piece to piece, runs document by document in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import profiles
from ..functions.text import level_label, strip, text

_N = "[0-9〇零两一二三四五六七八九十百千]+"
#: Statute headings in the order in which they are tried: kind and pattern with two groups.
HEADINGS = (
    ("part", rf"(?U)^\s*第\s*({_N})\s*编\s*(.*)$"),
    ("chapter", rf"(?U)^\s*第\s*({_N})\s*章\s*(.*)$"),
    ("section", rf"(?U)^\s*第\s*({_N})\s*节\s*(.*)$"),
    ("rules", r"(?U)^\s*(附)\s*(则)\s*$"),
    ("annex", r"(?U)^\s*附\s*件\s*([一二三四五六七八九十]+)\s*(.*)$"),
    ("article", rf"(?U)^\s*第\s*({_N})\s*条[：:．.\s]?(.*)$"),
)


def heading_kind(line: Column) -> Column:
    c = F.lit(None).cast("string")
    for kind, pattern in reversed(HEADINGS):
        c = F.when(line.rlike(pattern), kind).otherwise(c)
    return c


def _group(line: Column, kind: str, i: int) -> Column:
    return F.regexp_extract(line, dict(HEADINGS)[kind], i)


def _heading(line: Column, kind: str, unit: str) -> Column:
    return level_label(F.concat(_group(line, kind, 1), F.lit(" "), _group(line, kind, 2)), unit)


def articles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, seq, article_no, path struct<bian, zhang, jie>, text) for each article of a statute.

    A part resets chapter and section, a chapter the section; the closing rules are a chapter
    without a part; an annex is a section and an article of its own.  What stands before the first
    article and articles without text are dropped.
    """
    lines = docs.select(id_col, F.posexplode(F.split(text(F.col(text_col)), "\n")).alias("n", "raw")).withColumn("line", F.regexp_replace("raw", r"(?U)\s+$", ""))
    lines = lines.withColumn("kind", heading_kind(F.col("line")))
    w = Window.partitionBy(id_col).orderBy("n")
    k, line = F.col("kind"), F.col("line")
    lines = lines.withColumn("g1", F.sum(k.isin("part", "rules").cast("int")).over(w)).withColumn("g2", F.sum(k.isin("part", "rules", "chapter").cast("int")).over(w))
    part = F.when(k == "part", _heading(line, "part", "编"))
    chapter = F.when(k == "chapter", _heading(line, "chapter", "章")).when(k == "rules", "附则")
    section = F.when(k == "section", _heading(line, "section", "节")).when(k == "annex", F.concat(F.lit("附件"), _group(line, "annex", 1)))
    by = lambda *g: Window.partitionBy(id_col, *g).orderBy("n")
    lines = (
        lines.withColumn("bian", F.last(part, True).over(by("g1")))
        .withColumn("zhang", F.last(chapter, True).over(by("g2")))
        .withColumn("jie", F.last(section, True).over(by("g2")))
        .withColumn("art", F.sum(k.isin("article", "annex").cast("int")).over(w))
    )
    said = F.when(k == "article", _group(line, "article", 2)).when(k == "annex", _group(line, "annex", 2)).when(k.isNull(), line)
    no = F.when(k == "article", F.concat(F.lit("第"), _group(line, "article", 1), F.lit("条"))).when(k == "annex", F.concat(F.lit("附件"), _group(line, "annex", 1)))
    rows = lines.where("art > 0").groupBy(id_col, "art").agg(
        F.min_by(no, "n").alias("article_no"),
        F.min_by(F.struct("bian", "zhang", "jie"), "n").alias("path"),
        strip(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(said.isNotNull(), F.struct("n", said.alias("t"))))), lambda s: s["t"]), "\n")).alias("text"),
    )
    return rows.where("text <> ''").select(id_col, F.col("art").cast("long").alias("seq"), "article_no", "path", "text")


_HINT = re.compile(r"(?=（\d+）|（[一二三四五六七八九十]+）|^\s*[一二三四五六七八九十]+、)", re.M)


def split_long(article: str, hard: int = 1200, target: int = 700) -> list[str]:
    """A long article in pieces: at list marks, else at blank lines; then at sentence ends."""
    whole = article.strip()
    if len(whole) <= hard:
        return [whole]
    pieces = [p for p in _HINT.split(whole) if p.strip()]
    if len(pieces) < 2:
        pieces = [p.strip() for p in re.split(r"\n\s*\n", whole) if p.strip()] or [whole]
    joined: list[str] = []
    for p in pieces:
        if joined and len(joined[-1]) + 1 + len(p) < target * 1.4:
            joined[-1] += "\n" + p
        else:
            joined.append(p)
    out: list[str] = []
    for p in map(str.strip, joined):
        if len(p) <= hard:
            out.append(p)
            continue
        now = ""
        for s in re.findall(r"[^。；]*[。；]|[^。；]+$", p):
            if now and len(now) + len(s) >= target * 1.3:
                out.append(now)
                now = ""
            now += s
        out.append(now)
    return [x for x in map(str.strip, out) if x]


def pack(items: list[tuple[str, tuple, str]], most: int = 900, overlap: int = 100, strict: bool = False) -> list[tuple[str, tuple, str]]:
    """(span, path, text) chunks from (article_no, path, text) of one document, in order.

    Pieces of one scope are joined up to `most` characters.  By default the tail of a chunk goes
    into the next one only after an oversized piece; strict puts it before every next chunk of the
    same scope.
    """
    pieces = []
    for no, path, body in items:
        parts = split_long(body)
        pieces += [(no + (f"（续{i + 1}）" if len(parts) > 1 else ""), path, p) for i, p in enumerate(parts)]
    out, held, size = [], [], 0

    def flush(keep: bool) -> None:
        nonlocal held, size
        body = "\n".join(p[2] for p in held).strip()
        spans = [p[0] for p in held]
        out.append((spans[0] if len(set(spans)) == 1 else f"{spans[0]}~{spans[-1]}", held[0][1], body))
        held = [(*held[-1][:2], body[-overlap:])] if keep and overlap and body else []
        size = len(held[0][2]) if held else 0

    for piece in pieces:
        if held and held[-1][1] != piece[1]:
            flush(False)
        if size and size + 1 + len(piece[2]) <= most:
            held.append(piece)
            size += 1 + len(piece[2])
            continue
        if size:
            flush(strict)
        held = [*held, piece] if strict and held else [piece]
        size = sum(len(p[2]) + 1 for p in held) - 1
        if size >= most:
            flush(True)
    if size:
        flush(False)
    return out


CHUNK = "doc_id string, chunk_index long, article_no string, bian string, zhang string, jie string, text string"


def _names(ddl: str) -> list[str]:
    return [x.split()[0] for x in ddl.split(", ")]


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    cols = list(zip(*rows)) if rows else [()] * len(_names(ddl))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[x.split()[1]]) for c, x in zip(cols, ddl.split(", "))], names=_names(ddl))


def statute_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 900, overlap: int = 100, strict: bool = False) -> DataFrame:
    """Packed chunks of statutes, with dense indexes from 0."""
    item = F.struct("seq", "article_no", "path", "text")
    grouped = articles(docs, id_col, text_col).groupBy(F.col(id_col).cast("string").alias("doc_id")).agg(F.array_sort(F.collect_list(item)).alias("items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, items in zip(b.column(0).to_pylist(), b.column(1)):
                items = [(x["article_no"], (x["path"]["bian"], x["path"]["zhang"], x["path"]["jie"]), x["text"]) for x in items.as_py()]
                rows = [(doc, i, span, *path, body) for i, (span, path, body) in enumerate(pack(items, most, overlap, strict))]
                if rows:
                    yield _batch(rows, CHUNK)

    return grouped.mapInArrow(run, CHUNK)


_SENTENCE = re.compile(r"(?<=[。！？；])\s*(?![”』】）])")


def sentence_windows(body: str, least: int = 700, most: int = 1200, carry: int = 2) -> list[str]:
    """Sentences joined up to `most` characters; each chunk begins with the last `carry` of the one before; short neighbours are joined."""
    sentences = [s for s in _SENTENCE.split(body) if s and s.strip()]
    chunks, now = [], []
    for s in sentences:
        if now and sum(map(len, now)) + len(s) > most:
            chunks.append("".join(now))
            now = now[-carry:] if carry else []
        now.append(s)
    if now:
        chunks.append("".join(now))
    out: list[str] = []
    for c in chunks:
        if out and len(out[-1]) < least and len(out[-1]) + len(c) <= most * 1.2:
            out[-1] += c
        else:
            out.append(c)
    return out


SECTION_CHUNK = "doc_id string, section string, chunk_index long, text string"
WHOLE = frozenset({"主文", "依据"})


def section_chunks(sections: DataFrame, id_col: str = "doc_id", order: str = "seq", section_col: str = "section", text_col: str = "text", whole: frozenset[str] = WHOLE, least: int = 700, most: int = 1200, carry: int = 2) -> DataFrame:
    """Sentence chunks of each section, never across sections; holdings and grounds stay whole."""
    item = F.struct(F.col(order).cast("long").alias("o"), F.col(section_col).cast("string").alias("s"), F.col(text_col).cast("string").alias("t"))
    grouped = sections.groupBy(F.col(id_col).cast("string").alias("doc_id")).agg(F.array_sort(F.collect_list(item)).alias("items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, items in zip(b.column(0).to_pylist(), b.column(1)):
                rows, n = [], 0
                for x in items.as_py():
                    t = (x["t"] or "").strip()
                    for c in ([t] if t else []) if x["s"] in whole else sentence_windows(t, least, most, carry):
                        rows.append((doc, x["s"], n, c))
                        n += 1
                if rows:
                    yield _batch(rows, SECTION_CHUNK)

    return grouped.mapInArrow(run, SECTION_CHUNK)


PARTY = rf"(?U)^({profiles.PARTY_ROLES})([（(][^：:（）()]{{0,30}}[）)])*(\s*[：:]|[：:，,。；;、\s]*+(?!{profiles.NO_PARTY}))"


def section_name(line: Column, system: str = "") -> Column:
    """The section that a line begins, or null; titles first, then the system's, common and weak ones."""
    s = strip(line)
    c = F.lit(None).cast("string")
    for name, pattern in reversed((*profiles.SYSTEM_SECTIONS.get(system, ()), *profiles.SECTIONS, *profiles.WEAK_SECTIONS)):
        c = F.when(s.rlike(pattern), name).otherwise(c)
    return F.when(F.regexp_replace(s, r"(?U)\s+", "").rlike(profiles.TITLE), "标题").otherwise(c)


def is_party(line: Column) -> Column:
    return strip(line).rlike(PARTY)


def sections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", system: str = "") -> DataFrame:
    """(id, seq, section, text): a judgment cut where sections and runs of party lines begin.

    The case number counts once, in the first lines.  What stands before the first mark is 开头; a
    text without any mark is cut at blank lines into sections 正文.
    """
    lines = docs.select(id_col, F.posexplode(F.split(text(F.col(text_col)), "\n")).alias("n", "line"))
    w = Window.partitionBy(id_col).orderBy("n")
    name = section_name(F.col("line"), system)
    first_no = F.row_number().over(Window.partitionBy(id_col, name).orderBy("n"))
    name = F.when((name == "案号行") & ((F.col("n") > 30) | (F.col("k") > 1)), None).otherwise(name)
    lines = lines.withColumn("k", first_no).withColumn("party", is_party(F.col("line")) & section_name(F.col("line"), system).isNull())
    lines = lines.withColumn("name", name)
    lines = lines.withColumn("in_party", F.last(F.when(F.col("name").isNotNull(), False).when(F.col("party"), True).when(strip(F.col("line")) == "", False), True).over(w))
    was = F.coalesce(F.lag("in_party").over(w), F.lit(False))
    lines = lines.withColumn("mark", F.when(F.col("name").isNotNull(), F.col("name")).when(F.col("in_party") & ~was, "当事人信息"))
    lines = lines.withColumn("any", F.max(F.col("mark").isNotNull()).over(Window.partitionBy(id_col)))
    blank_before = F.coalesce(strip(F.lag("line").over(w)) == "", F.lit(True))
    lines = lines.withColumn("mark", F.when(F.col("any"), F.col("mark")).when(blank_before & (strip(F.col("line")) != ""), "正文"))
    lines = lines.withColumn("seq", F.sum(F.col("mark").isNotNull().cast("int")).over(w))
    got = lines.groupBy(id_col, "seq").agg(F.coalesce(F.min_by("mark", "n"), F.lit("开头")).alias("section"), strip(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda s: s["line"]), "\n")).alias("text"))
    return got.where("text <> ''").select(id_col, F.col("seq").cast("long").alias("seq"), "section", "text")


_CN = "[一二三四五六七八九十百千万零两0-9]+"
CLAUSE = rf"(?U)^\s*(第{_CN}条)\s*([^\n\r，。,：:]{{0,40}})"
CHAPTER = rf"(?U)^\s*(第{_CN}章)\s*([^\n\r，。,：:]{{0,40}})"
NUMBERED = r"(?U)^\s*([0-9]{1,3}|[一二三四五六七八九十]+|[（(][一二三四五六七八九十0-9]{1,3}[)）])[.．、)]\s*([^\n\r]{0,60})"


def clauses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heading: str = CLAUSE) -> DataFrame:
    """(id, order, clause_no, title, text): a contract cut at one kind of heading.

    A heading counts only after a line that ends, not after a comma or in mid-sentence.  What
    stands before the first is a preface without a number.
    """
    lines = docs.select(id_col, F.posexplode(F.split(text(F.col(text_col)), "\n")).alias("n", "line"))
    w = Window.partitionBy(id_col).orderBy("n")
    before = F.last(F.when(strip(F.col("line")) != "", strip(F.col("line"))), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    ended = before.isNull() | before.rlike("[。；;：:！!？?）)】」』”\"]$") | before.rlike(heading) | (F.length(before) < 20) & ~before.rlike("[，,、]$")
    lines = lines.withColumn("head", F.col("line").rlike(heading) & ended).withColumn("g", F.sum(F.col("head").cast("int")).over(w))
    got = lines.groupBy(id_col, "g").agg(F.min_by(F.when(F.col("head"), F.col("line")), "n").alias("h"), strip(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda s: s["line"]), "\n")).alias("text")).where("text <> ''")
    no, title = F.regexp_extract(F.coalesce("h", F.lit("")), heading, 1), strip(F.regexp_extract(F.coalesce("h", F.lit("")), heading, 2))
    order = F.row_number().over(Window.partitionBy(id_col).orderBy("g")).cast("long")
    return got.select(id_col, order.alias("order"), no.alias("clause_no"), title.alias("title"), "text")


def contract_clauses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """clauses() by the first kind of heading that gives more than one row: clause, chapter, number; else one."""
    tries = None
    for rank, heading in enumerate((CLAUSE, CHAPTER, NUMBERED)):
        one = clauses(docs, id_col, text_col, heading).withColumn("rank", F.lit(rank)).withColumn("rows", F.count("*").over(Window.partitionBy(id_col)))
        tries = one if tries is None else tries.unionByName(one)
    fits = F.min(F.when(F.col("rows") > 1, F.col("rank"))).over(Window.partitionBy(id_col))
    return tries.withColumn("best", F.coalesce(fits, F.lit(0))).where("rank = best").drop("rank", "rows", "best")


def heading_level(no: Column) -> Column:
    """1 for chapters, clauses and plain numbers; one more for each dot; 2 for bracketed ones."""
    n = strip(text(no))
    dots = F.length(n) - F.length(F.replace(n, F.lit("."), F.lit("")))
    plain = n.rlike(r"^[一二三四五六七八九十百千万两0-9]+(\.[0-9]+)*$")
    return F.when(n.rlike("^第[^\n\r]{1,6}[章条]$"), 1).when(plain, dots + 1).when(n.rlike("^[（(][一二三四五六七八九十0-9]{1,4}[)）]$"), 2).otherwise(1)


def with_parents(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """clauses with level, parent_section and section_path: the last heading of level 1, then their own."""
    w = Window.partitionBy(id_col).orderBy("order")
    label = F.trim(F.concat_ws(" ", F.nullif("clause_no", F.lit("")), F.nullif("title", F.lit(""))))
    r = rows.withColumn("level", heading_level(F.col("clause_no"))).withColumn("label", label)
    numeric = F.col("clause_no").rlike("^[0-9]")
    named = F.last(F.when((F.col("level") == 1) & ~numeric & (F.col("label") != ""), F.col("label")), True).over(w)
    r = r.withColumn("level", F.when((F.col("level") == 1) & numeric & named.isNotNull(), 2).otherwise(F.col("level")))
    r = r.withColumn("parent_section", F.last(F.when((F.col("level") == 1) & (F.col("label") != ""), F.col("label")), True).over(w))
    own = F.when((F.col("level") > 1) & (F.col("label") != "") & ~F.col("label").eqNullSafe(F.col("parent_section")), F.col("label"))
    return r.withColumn("section_path", F.filter(F.array("parent_section", own), lambda x: x.isNotNull())).drop("label")
