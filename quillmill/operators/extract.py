"""Facts read from legal texts: what they are, what they change, whom they judge."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import profiles
from ..functions.numerals import NUMERAL, cn_amount, cn_date, term_months
from ..functions.text import keyword_score, repair_citations, squeeze, strip, text


def doc_type(body: Column, path: Column) -> Column:
    """The longest document type that a line of the head ends in, or that the file name has."""
    lines = F.transform(F.split(F.substring(text(body), 1, 3000), "\n"), lambda x: F.regexp_replace(x, r"(?U)\s+", ""))
    base = F.regexp_replace(F.regexp_replace(text(path), r"^.*[/\\]", ""), r"\.[^.]*$", "")
    found = F.concat(
        F.transform(lines, lambda x: F.regexp_replace(F.regexp_extract(x, f"((?:{profiles.DOC_TYPE_FIELDS})?(?:{profiles.DOC_TYPE_TAILS}))$", 1), "^赔偿(?=赔偿)", "")),
        F.regexp_extract_all(F.regexp_replace(base, r"(?U)\s+", ""), F.lit(f"((?:{profiles.DOC_TYPE_FIELDS})?(?:{profiles.DOC_TYPE_TAILS}))"), F.lit(1)),
    )
    best = F.aggregate(found, F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    return best


CASE_NO = r"[（(][0-9]{4}[）)]\s*[\x{4e00}-\x{9fa5}A-Z0-9]{2,}[0-9]+号"
_CASE = r"[（(]\s*(20[0-9]{2})\s*[）)]\s*([^\s\n号]*?)\s*([0-9]+)号"
LEVELS = tuple(sorted(((code, level) for level, codes in profiles.CASE_CODES for code in codes.split()), key=lambda x: -len(x[0])))


def case_number(body: Column) -> Column:
    return F.regexp_extract(F.substring(text(body), 1, 4000), CASE_NO, 0)


def trial_level(body: Column, number: Column) -> Column:
    """By the case code, else by special codes, else by the body; empty if nothing tells."""
    src = F.when(text(number) != "", number).otherwise(F.regexp_extract(F.substring(text(body), 1, 6000), _CASE, 0))
    code = F.regexp_extract(src, _CASE, 2)
    head = F.substring(text(body), 1, 8000)
    c = F.lit("")
    for pattern, level in reversed(profiles.BODY_LEVELS):
        c = F.when(head.rlike(pattern), level).otherwise(c)
    for has, level in reversed(profiles.SPECIAL_CODES):
        c = F.when(src.rlike(has), level).otherwise(c)
    for k, level in reversed(LEVELS):
        c = F.when(code.contains(k), level).otherwise(c)
    return c


def execution_subtype(name: Column) -> Column:
    c = F.lit("其他执行")
    for label, pattern in reversed(profiles.EXECUTION):
        c = F.when(text(name).rlike(pattern), label).otherwise(c)
    return c


def system_of_path(path: Column) -> Column:
    """struct(system, subtype) of a relative path `system/subtype/file`."""
    p = F.split(F.replace(text(path), F.lit("\\"), F.lit("/")), "/")
    n = F.size(p)
    system = F.when(n >= 2, F.regexp_replace(F.trim(F.get(p, F.lit(0))), "^国赔$", "国家赔偿")).otherwise("")
    sub = F.when(system == "执行", execution_subtype(F.get(p, n - 1))).when(n >= 3, F.trim(F.get(p, F.lit(1)))).otherwise("")
    return F.struct(system.alias("system"), sub.alias("subtype"))


def court(body: Column) -> Column:
    """The court in the lines above the case number, topmost first, else the first one named."""
    lines = F.split(F.substring(text(body), 1, 4000), "\n")
    named = r"[\x{4e00}-\x{9fa5}]{2,30}?人民法院(赔偿委员会)?"
    at = F.array_position(F.transform(lines, lambda x: x.rlike(CASE_NO)), F.lit(True)).cast("int")
    above = F.filter(lines, lambda x, i: (i < at - 1) & (i >= at - 6) & F.regexp_replace(x, r"(?U)\s+", "").rlike(f"^{named}$"))
    return F.coalesce(F.regexp_replace(F.get(above, F.lit(0)), r"(?U)\s+", ""), F.regexp_replace(F.regexp_extract(text(body), named, 0), "^(?:本案|现|依法)*(?:上诉至|不服|由|经|向)", ""))


def judgment_date(body: Column) -> Column:
    """The date in Chinese numerals that is most likely the judgment's, as ISO; null for none.

    A date scores its distance from the end of the text, and 1000 more without a word of judgment
    within 20 characters; the least score wins, then the latest date.
    """
    t = text(body)
    found, between = F.regexp_extract_all(t, F.lit(f"({profiles.DATE})"), F.lit(1)), F.split(t, profiles.DATE, -1)
    total = lambda parts: F.aggregate(F.transform(parts, F.length), F.lit(0), lambda a, n: a + n)

    def scored(d: Column, i: Column) -> Column:
        start = total(F.slice(between, 1, i + 1)) + total(F.slice(found, 1, i))
        around = F.substring(t, F.greatest(start - 19, F.lit(1)), start + F.length(d) + 20 - F.greatest(start - 20, F.lit(0)))
        iso = cn_date(F.translate(d, "○ＯO", "〇〇〇"))
        score = F.when(around.rlike(profiles.JUDGED), 0).otherwise(1000) + F.length(t) - start
        return F.struct(score.alias("score"), (-F.translate(iso, "-", "").cast("int")).alias("late"), iso.alias("iso"))

    return F.array_min(F.filter(F.transform(found, scored), lambda x: x["iso"].isNotNull()))["iso"]


# --- citations by a cursor ---

_TOK = NUMERAL[:-1] + "○ＯO]"
_ART = re.compile(rf"第{_TOK}+(?:之{_TOK}+)?条(?:第{_TOK}+款)?(?:第{_TOK}+[项目段])?")
_TITLE = re.compile(r"《([^》\n]{1,60})》")
_PAREN = re.compile(r"\s*(（[^）]*）|\([^)]*\)|【[^】]*】|\[[^\]]*\]|〔[^〕]*〕)")
_JOIN = frozenset("、,，；;和及与或并至到—-~ 　")
_GOOD, _BAD = re.compile(profiles.NORMATIVE), re.compile(profiles.NOT_NORMATIVE)


def statute_list(body: str, reach: int = 160, most: int = 50) -> list[str]:
    """`《title》article` for each article after a normative title, in order and once each."""
    out: dict[str, str] = {}
    for m in _TITLE.finditer(body):
        name = re.sub(r"[（(][^）)]*[）)]$", "", m[1]).strip()
        if not _GOOD.search(name) or _BAD.search(name):
            continue
        title, at = m[0], m.end()
        while (p := _PAREN.match(body, at)) and len(p[1]) <= 24:
            if not re.search("以下简称|下称|简称", p[1]):
                title += p[1]
            at = p.end()
        end = min(len(body), at + reach)
        while at < end:
            if a := _ART.match(body, at):
                said = title + a[0]
                out.setdefault(re.sub(r"\s|(?<=》)(?:（[^）]{0,30}）|\([^)]{0,30}\))+", "", said), said)
                at = a.end()
            elif body[at].isspace() or body[at] in _JOIN:
                at += 1
            elif (p := _PAREN.match(body, at)) and len(p[1]) <= 40:
                at = p.end()
            else:
                break
    return list(out.values())[:most]


def statutes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, statutes): the citations of each text, broken ones repaired first."""
    own = docs.select(F.col(id_col).cast("string").alias("doc_id"), repair_citations(F.col(text_col)).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([statute_list(t) for t in b.column(1).to_pylist()], pa.list_(pa.string()))], names=["doc_id", "statutes"])

    return own.mapInArrow(run, "doc_id string, statutes array<string>")


# --- amendments ---

_O, _C = "[《〈]", "[》〉]"
_NO = f"[{profiles.CN_NUM}]{{1,3}}"
AMENDS = (
    rf"关于修改{_O}(.+?){_C}.*?的决定",
    rf"{_NO}、\s*修改{_O}(.+?){_C}",
    rf"{_NO}、\s*对{_O}(.+?){_C}(?:作出|作如下|予以|相应)修改",
    rf"（{_NO}）\s*{_O}([^》〉]+?){_C}(?=(?:[^（）()]|[（(][^）)]*[）)]){{0,240}}?(?:{profiles.STRICT_EDITS}))",
)


def _once(names: Column) -> Column:
    """Names in marks, the first of each that are alike without blanks and brackets."""
    keyed = F.transform(names, lambda n, i: F.struct(F.regexp_replace(F.translate(n, "（）", "()"), r"(?U)\s+", "").alias("k"), n.alias("n"), i.alias("i")))
    firsts = F.filter(keyed, lambda x, i: ~F.exists(F.slice(keyed, 1, F.greatest(i, F.lit(1))), lambda y: (y["k"] == x["k"]) & (y["i"] < x["i"])))
    return F.transform(firsts, lambda x: F.concat(F.lit("《"), strip(x["n"]), F.lit("》")))


def amended_laws(body: Column) -> Column:
    """Names of the laws that a decision amends, by four ways to say so, in the order of the text."""
    t = squeeze(body)
    found = []
    for i, p in enumerate(AMENDS):
        where = F.substring(t, 1, 400) if i == 0 else t
        hits = F.arrays_zip(F.regexp_extract_all(where, F.lit(p), F.lit(0)).alias("whole"), F.regexp_extract_all(where, F.lit(p), F.lit(1)).alias("name"))
        hits = F.transform(hits, lambda h, i=i: F.struct(F.call_function("instr", t, h["whole"]).alias("at"), F.lit(i).alias("way"), h["name"].alias("name")))
        found.append(F.slice(hits, 1, 1) if i == 0 else hits)
    return _once(F.transform(F.array_sort(F.concat(*found)), lambda h: h["name"]))


def repealed_laws(body: Column) -> Column:
    """Names of the laws in sentences on repeal, without decisions, bills and notices."""
    parts = F.regexp_extract_all(squeeze(body), F.lit("废止([^。；;]+)"), F.lit(1))
    names = F.flatten(F.transform(parts, lambda p: F.regexp_extract_all(p, F.lit(rf"{_O}(.+?){_C}"), F.lit(1))))
    return _once(F.filter(names, lambda n: ~n.rlike(profiles.NO_REPEALED_LAW)))


# --- contracts ---

KEYWORDS = profiles.KEYWORDS
UNCERTAIN = "uncertain"


def nda_gate(title: Column, body: Column) -> Column:
    """Two anchors at least, counted in title and body, and no word of insurance."""
    n = F.lit(0)
    for c in (text(title), text(body)):
        for a in profiles.NDA_ANCHORS:
            n = n + c.rlike(f"(?i){a}").cast("int")
    return (n >= 2) & ~text(title).rlike(profiles.INSURANCE) & ~text(body).rlike(profiles.INSURANCE)


def classify(docs: DataFrame, keywords: dict[str, str] = KEYWORDS, title: str = "title", body: str = "body", least: int = 3, margin: int = 1, chars: int | None = 2000, gates: dict[str, Column] | None = None) -> DataFrame:
    """docs with scores map and label: the best of at least `least` points and `margin` above the next, else uncertain."""
    b = text(F.col(body)) if chars is None else F.substring(text(F.col(body)), 1, chars)
    labels = sorted(keywords)
    d = docs.withColumn("scores", F.create_map(*[x for k in labels for x in (F.lit(k), keyword_score(F.col(title), b, keywords[k].split()).cast("long"))]))
    ranked = F.array_sort(F.transform(F.map_entries("scores"), lambda e: F.struct((-e["value"]).alias("s"), e["key"].alias("k"))))
    best, next_ = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))
    won = (-best["s"] >= least) & (next_["s"].isNull() | (next_["s"] - best["s"] >= margin))
    label = F.when(won, best["k"]).otherwise(UNCERTAIN)
    for name, gate in ({"nda": nda_gate(F.col(title), b)} if gates is None else gates).items():
        label = F.when((label == name) & ~gate, UNCERTAIN).otherwise(label)
    return d.withColumn("label", label)


def label_histogram(classified: DataFrame, labels: list[str]) -> DataFrame:
    """(label, n) for all labels, those without a document too."""
    spark = classified.sparkSession
    dim = spark.createDataFrame([(x,) for x in [*labels, UNCERTAIN]], "label string")
    return dim.join(classified.groupBy("label").agg(F.count("*").alias("c")), "label", "left").select("label", F.coalesce("c", F.lit(0)).alias("n"))


# --- criminal judgments ---


def verdict(body: Column) -> Column:
    return strip(F.regexp_extract(text(body), r"(?s)判决(?:如下|结果)\s*[:：]?(.*)$", 1))


def defendants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, name, alias): the accused that a text names, once each; a guess at the bare name of a masked one."""
    t = text(F.col(text_col))
    names = F.regexp_extract_all(t, F.lit(r"(?:^|\n)\s*被告人\s*([\x{4e00}-\x{9fa5}·]{2,4})(?=[，,（(。])"), F.lit(1))
    each = docs.select(id_col, t.alias("t"), F.explode(F.array_distinct(names)).alias("name"))
    guess = F.filter(F.regexp_extract_all("t", F.concat(F.lit("("), F.substring("name", 1, 1), F.lit(r"[\x{4e00}-\x{9fa5}]{1,2})")), F.lit(1)), lambda x: x != F.col("name"))
    masked = F.col("name").rlike("[某X×]")
    return each.select(id_col, "name", F.when(masked, F.get(guess, F.lit(0))).alias("alias"))


def dispositions(docs: DataFrame, accused: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, name, offence, term, months, fine, confiscation, term_start, term_end, probation, offset): what the verdict gives each accused.

    Items begin with 一、; one goes to the accused that it names, or to the only one.  Later items
    win, probation and offset hold once said.
    """
    body = F.regexp_replace(verdict(F.col(text_col)), r"\n(?!\s*[一二三四五六七八九十]+、)", " ")
    items = docs.select(id_col, F.posexplode(F.filter(F.split(body, "\n"), lambda x: strip(x) != "")).alias("i", "s"))
    alone = F.count("*").over(Window.partitionBy(id_col)) == 1
    who = accused.withColumn("alone", alone)
    hits = items.join(who, id_col).where(F.col("s").contains(F.col("name")) | F.coalesce(F.col("s").contains(F.col("alias")), F.lit(False)) | F.col("alone"))
    s = F.col("s")
    offence = F.regexp_extract(s, r"犯([^\s，。；、]*?罪)[，、]", 1)
    timed = F.regexp_extract(s, r"(?:有期徒刑|拘役|管制)([〇零一二两三四五六七八九十百千0-9年个月日\s]+)", 1)
    term = F.when(strip(timed) != "", strip(timed)).when(s.contains("无期徒刑"), "无期徒刑").when(s.contains("死刑缓期"), "死刑缓期二年执行").when(s.contains("死刑"), "死刑")
    fine = cn_amount(F.regexp_extract(s, r"罚金(?:人民币)?\s*([〇零一二两三四五六七八九十百千万亿0-9]+)\s*元", 1))
    taken = cn_amount(F.regexp_extract(s, profiles.CONFISCATED, 1))
    start, end = (cn_date(F.regexp_extract(s, profiles.SERVED, i)) for i in (1, 2))
    rows = hits.select(id_col, "name", "i", F.nullif(offence, F.lit("")).alias("offence"), term.alias("term"), term_months(term).alias("months"), fine.alias("fine"), taken.alias("confiscation"), start.alias("term_start"), end.alias("term_end"), s.contains("缓刑").alias("probation"), s.contains("折抵刑期").alias("offset"))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("i"))).alias(c)
    return rows.groupBy(id_col, "name").agg(*map(last, ("offence", "term", "months", "fine", "confiscation", "term_start", "term_end")), F.max("probation").alias("probation"), F.max("offset").alias("offset"))


def factors(docs: DataFrame, accused: DataFrame, id_col: str = "doc_id", text_col: str = "opinion") -> DataFrame:
    """(id, name, factor, holds): the last sentence that mentions a factor decides; a negation up to six characters before denies it."""
    each = docs.select(id_col, F.posexplode(F.split(text(F.col(text_col)), "[。！？]")).alias("i", "s"))
    word = F.explode(F.map_from_arrays(F.array(*map(F.lit, profiles.FACTORS)), F.array(*map(F.lit, profiles.FACTORS.values())))).alias("factor", "word")
    each = each.select("*", word).where(F.col("s").contains(F.col("word")))
    denied = F.regexp_like("s", F.concat(F.lit(f"(?:{profiles.DENIALS}).{{0,6}}"), F.col("word")))
    who = accused.withColumn("alone", F.count("*").over(Window.partitionBy(id_col)) == 1)
    names = F.col("s").contains(F.col("name")) | F.coalesce(F.col("s").contains(F.col("alias")), F.lit(False))
    all_ = F.col("alone") | F.col("s").rlike(profiles.ALL_ACCUSED)
    any_named = F.max(names).over(Window.partitionBy(id_col, "i", "factor"))
    hits = each.withColumn("denied", denied).join(who, id_col).withColumn("named", names).withColumn("any_named", any_named)
    hits = hits.where(F.col("named") | (~F.col("any_named") & all_))
    return hits.groupBy(id_col, "name", "factor").agg(F.max_by(~F.col("denied"), "i").alias("holds"))


def opinion_summary(opinion: Column, k: int = 3) -> Column:
    """The k sentences of most weight, the shorter first among equals, each once."""
    sents = F.array_distinct(F.filter(F.transform(F.split(text(opinion), "[。！？]"), strip), lambda s: s != ""))

    def weight(s: Column) -> Column:
        total = F.lit(0)
        for word, n in profiles.OPINION_WEIGHTS.items():
            total = total + F.when(s.contains(word), n).otherwise(0)
        return total

    ranked = F.array_sort(F.transform(sents, lambda s, i: F.struct((-weight(s)).alias("w"), F.length(s).alias("n"), i.alias("i"), s.alias("s"))))
    return F.transform(F.slice(ranked, 1, k), lambda x: F.concat(x["s"], F.lit("。")))


def dispute_focus(opinion: Column, defence: Column, most: int = 5) -> Column:
    """Sentences on what is in dispute, in order, once each."""
    sents = F.filter(F.transform(F.split(F.concat_ws("。", text(opinion), text(defence)), "。"), strip), lambda s: s.rlike(profiles.DISPUTE[0]) & s.rlike(profiles.DISPUTE[1]))
    return F.slice(F.array_distinct(F.transform(sents, lambda s: F.concat(s, F.lit("。")))), 1, most)
