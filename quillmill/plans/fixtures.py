"""Queries over fixed rows in Chinese, which the tables do not have; their SQL gives the rows expected."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.numerals import cn_amount, cn_date, cn_to_int, expand_articles, term_months
from ..operators import complete, extract, link, pages, presence, rawinput, segment
from .registry import query, rows_sql

_NUMERALS = [
    ("一", 1), ("十", 10), ("十二", 12), ("二十", 20), ("一百一十", 110), ("一百二十三", 123), ("一千一百六十四", 1164), ("一千二百", 1200),
    ("第十二条", 12), ("第九十条之一", 90), ("二 十", 20), ("一百零五", 105), ("一万二千", 12000), ("二〇二〇", 2020), ("两百", 200), ("１２", 12), ("", 0), ("甲", 0), (None, 0),
]


@query(rows_sql("text string, value long", _NUMERALS))
def cn_numeral_parse(spark, sf):
    return spark.createDataFrame(_NUMERALS, "text string, value long").select("text", cn_to_int(F.col("text")).alias("value"))


_ARTICLES = [("第一条至第三条、第五条", "1,2,3,5"), ("第一条（续1）~第三条", "1,2,3"), ("3-5，8", "3,4,5,8"), ("第十条", "10"), ("第九条至第七条", "7,8,9"), ("", "")]


@query(rows_sql("text string, articles string", _ARTICLES))
def article_list_expand(spark, sf):
    return spark.createDataFrame(_ARTICLES, "text string, articles string").select("text", F.array_join(expand_articles(F.col("text")).cast("array<string>"), ",").alias("articles"))


_TERMS = [("三年六个月", 42), ("十个月", 10), ("一年", 12), ("无期徒刑", -1), ("", -1)]


@query(rows_sql("term string, months long", _TERMS))
def prison_term_months(spark, sf):
    return spark.createDataFrame(_TERMS, "term string, months long").select("term", F.coalesce(term_months(F.col("term")), F.lit(-1)).alias("months"))


_DATES = [("二〇二〇年二月三日", "2020-02-03"), ("２０２１年12月31日", "2021-12-31"), ("二〇二〇年二月三十日", None), ("某年", None)]


@query(rows_sql("said string, day string", _DATES))
def cn_date_normalize(spark, sf):
    return spark.createDataFrame(_DATES, "said string, day string").select("said", cn_date(F.col("said")).alias("day"))


_AMOUNTS = [("一亿二千万元", 120000000), ("五千元", 5000), ("3万元", 30000), ("零", -1)]


@query(rows_sql("said string, amount long", _AMOUNTS))
def cn_amount_parse(spark, sf):
    return spark.createDataFrame(_AMOUNTS, "said string, amount long").select("said", F.coalesce(cn_amount(F.col("said")), F.lit(-1)).alias("amount"))


_NAMES = [("《中华人民共和国 刑法》", "刑法", "刑法"), ("民事诉讼法（2017年修正）", "民事诉讼法", "民事诉讼法（2017年修正）"), ("〈合同〉法·总则", "合同法总则", "〈合同〉法·总则"), ("", "", "")]


@query(rows_sql("raw string, deep string, plain string", _NAMES))
def law_name_norm(spark, sf):
    d = spark.createDataFrame(_NAMES, "raw string, deep string, plain string")
    return d.select("raw", tx.law_name(F.col("raw")).alias("deep"), tx.law_name(F.col("raw"), deep=False).alias("plain"))


_CLEANED = [("甲：１２、乙\r\n\r\n\r\n丙　丁", "甲:12、乙\n\n丙 丁"), ("  第 3 条 之 1 ", "第 3 条 之 1")]


@query(rows_sql("raw string, text string", _CLEANED))
def clean_contract_text(spark, sf):
    return spark.createDataFrame(_CLEANED, "raw string, text string").select("raw", tx.clean_contract(F.col("raw")).alias("text"))


_CITING = [("c1", "依照《民法典》第一百零五条和《中华人民共和国刑法》第12条，另见《公司法》"), ("c2", "《A法》和《B法》第三条"), ("c3", None)]
_CITATIONS = [("c1", "民法典", 105), ("c1", "刑法", 12), ("c2", "B法", 3)]


@query(rows_sql("chunk_id string, law_norm string, article long", _CITATIONS))
def citation_extract(spark, sf):
    return link.citations(spark.createDataFrame(_CITING, "chunk_id string, text string")).select("chunk_id", "law_norm", "article")


_CHUNK_DDL = "chunk_id string, doc_id string, doc_type string, title string, law_name string, law_alias array<string>, article_no string, version_date string, bian string, zhang string, jie string"
_CHUNKS = [
    ("k1", "LAW-CODE", "statute", "民法典", "民法典", [], "第一条~第一百条", "2021-01-01", "第一编 总则", None, None),
    ("k2", "LAW-CODE", "statute", "民法典", "民法典", [], "第四百六十三条~第五百条", "2021-01-01", "第三编 合同", None, None),
    ("k3", "LAW-CRIM-97", "statute", "刑法", "中华人民共和国刑法", ["旧刑律"], "第二百三十二条~第二百三十四条", "1997-10-01", None, None, None),
    ("k4", "LAW-CRIM-20", "statute", "刑法", "中华人民共和国刑法", [], "第二百三十二条~第二百三十四条", "2020-12-26", None, None, None),
    ("k5", "JI-CIVIL", "judicial_interpretation", "解释", "最高人民法院关于适用《中华人民共和国民事诉讼法》的解释", [], "第一条~第五条", "2022-04-10", None, None, None),
    ("k6", "JI-CRIM", "judicial_interpretation", "解释", "最高人民法院关于适用《中华人民共和国刑事诉讼法》的解释", [], "第一条~第九条", "2021-03-01", None, None, None),
]
_JUDGED = [
    ("j1", "criminal", ["《刑法》第二百三十二条", "《中华人民共和国刑法》第二百三十三条至第二百三十四条"]),
    ("j2", "civil", ["《合同法》第四百七十条", "《民法总则》第五十条", "《合同法》第九十条"]),
    ("j3", "civil", ["《关于适用的解释》第三条", "《旧刑律》第二百三十二条"]),
    ("j4", "criminal", ["《最高人民法院关于适用的解释》第八条", "《某某市管理条例》第一条", "《不存在法》第一条", "《刑法》"]),
    ("j5", "civil", ["《民法典》第一条至第三十条"]),
]
_EDGES = [
    ("j1", "LAW-CRIM-20", "232,233,234"), ("j2", "LAW-CODE", "50,470"), ("j3", "JI-CIVIL", "3"), ("j3", "LAW-CRIM-97", "232"), ("j4", "JI-CRIM", "8"), ("j5", "LAW-CODE", ""),
]


def _graph(spark):
    chunks = spark.createDataFrame(_CHUNKS, _CHUNK_DDL).withColumn("path", F.struct("bian", "zhang", "jie"))
    return chunks, spark.createDataFrame(_JUDGED, "doc_id string, system string, statutes array<string>")


@query(rows_sql("from_doc string, to_doc string, articles string", _EDGES))
def judgment_statute_links(spark, sf):
    chunks, judged = _graph(spark)
    edges, _, _ = link.apply_edges(judged, chunks, "LAW-CODE")
    return edges.select("from_doc", "to_doc", F.array_join(F.col("articles").cast("array<string>"), ",").alias("articles"))


@query(rows_sql("from_doc string, law_norm string", [("j4", "不存在法")]))
def judgment_link_misses(spark, sf):
    chunks, judged = _graph(spark)
    return link.apply_edges(judged, chunks, "LAW-CODE")[2].select("from_doc", "law_norm")


@query(rows_sql("chunk_id string, law_alias string", [("k1", "民法总则"), ("k2", "合同法"), ("k3", "旧刑律"), ("k4", "中华人民共和国刑法"), ("k5", ""), ("k6", "")]))
def alias_writeback(spark, sf):
    chunks, judged = _graph(spark)
    got = link.write_aliases(chunks, link.apply_edges(judged, chunks, "LAW-CODE")[1])
    return got.select("chunk_id", F.array_join(F.array_sort("law_alias"), ",").alias("law_alias"))


@query(rows_sql("entry string, n long", [("《刑法》", 1)]))
def mention_failures(spark, sf):
    return link.mention_failures(_graph(spark)[1])


@query(rows_sql("section string, articles long", [("总则编", 100), ("合同编", 38)]))
def code_sections(spark, sf):
    return link.code_sections(_graph(spark)[0], "LAW-CODE").select("section", F.size("section_articles").cast("long").alias("articles"))


_UNCITABLE = [("某某市管理条例", True), ("协调会纪要", True), ("刑法", False), ("", True), ("失业保险条例", True), ("民事诉讼法", False)]


@query(rows_sql("name string, uncitable boolean", _UNCITABLE))
def blacklist_predicate(spark, sf):
    return spark.createDataFrame(_UNCITABLE, "name string, uncitable boolean").select("name", link.uncitable(F.col("name")).alias("uncitable"))


_STATUTE = "前言\n第一编 总则\n第一章 基本 规定\n第一条 甲。\n乙。\n\n第二条 丙。\n第二章 自然人\n第一节 能力\n第三条 丁。\n第二编 物权\n第四条 戊。\n附 则\n第五条 己。\n附件一 表\n庚"
_PARSED = [
    (1, "第一条", "第一编 总则", "第一章 基本规定", None, "甲。\n乙。"), (2, "第二条", "第一编 总则", "第一章 基本规定", None, "丙。"), (3, "第三条", "第一编 总则", "第二章 自然人", "第一节 能力", "丁。"),
    (4, "第四条", "第二编 物权", None, None, "戊。"), (5, "第五条", None, "附则", None, "己。"), (6, "附件一", None, "附则", "附件一", "表\n庚"),
]


@query(rows_sql("seq long, article_no string, bian string, zhang string, jie string, text string", _PARSED))
def article_segmentation(spark, sf):
    d = spark.createDataFrame([("d", _STATUTE)], "doc_id string, text string")
    return segment.articles(d).select("seq", "article_no", "path.bian", "path.zhang", "path.jie", "text")


_JUDGMENT = "某某县人民法院\n民事判决书\n（2023）川01民初12号\n原告：张三，男。\n住所地：某县。\n被告：李四。\n\n诉讼请求：\n一、返还。\n本院认为\n应予支持。\n判决如下\n一、李四返还张三。\n审判员 王五"
_CUT = [(0, "开头", "某某县人民法院"), (1, "标题", "民事判决书"), (2, "案号行", "（2023）川01民初12号"), (3, "当事人信息", "原告：张三，男。\n住所地：某县。\n被告：李四。"), (4, "诉讼请求", "诉讼请求：\n一、返还。"), (5, "理由", "本院认为\n应予支持。"), (6, "主文", "判决如下\n一、李四返还张三。"), (7, "尾部", "审判员 王五")]


@query(rows_sql("seq long, section string, text string", _CUT))
def section_split(spark, sf):
    d = spark.createDataFrame([("d", _JUDGMENT)], "doc_id string, text string")
    return segment.sections(d, system="民事").select("seq", "section", "text")


_CONTRACT = "买卖合同\n第一条 标的 \n货物。\n如下依照第二款，\n第二条 价款\n一百元。\n第三条\n争议。"
_CLAUSES = [(1, "", "", "买卖合同"), (2, "第一条", "标的", "第一条 标的 \n货物。\n如下依照第二款，\n第二条 价款\n一百元。"), (3, "第三条", "", "第三条\n争议。")]


@query(rows_sql("\"order\" long, clause_no string, title string, text string".replace('"', ""), _CLAUSES).replace(" order", ' "order"').replace("(order", '("order"').replace("select order", 'select "order"'))
def contract_clause_split(spark, sf):
    d = spark.createDataFrame([("d", _CONTRACT)], "doc_id string, text string")
    return segment.contract_clauses(d).select("order", "clause_no", "title", "text")


_LEVELS = [("第三章", 1), ("第一条", 1), ("3", 1), ("3.1", 2), ("3.1.2", 3), ("（一）", 2), ("", 1)]


@query(rows_sql("no string, level int", _LEVELS))
def heading_levels(spark, sf):
    return spark.createDataFrame(_LEVELS, "no string, level int").select("no", segment.heading_level(F.col("no")).alias("level"))


_TYPED = [
    ("某法院\n民 事 判 决 书\n（2023）川01民终12号", "a/民事/x.txt", "民事判决书", "（2023）川01民终12号", "二审", "民事", ""),
    ("通知", "刑事/盗窃/某某刑事裁定书.txt", "刑事裁定书", "", "", "刑事", "盗窃"),
    ("(2021)京02执34号", "执行/案外人执行异议.txt", "", "(2021)京02执34号", "执行程序", "执行", "执行异议"),
    ("本裁定为终审裁定", "国赔/x/y.txt", "", "", "二审", "国家赔偿", "x"),
]
_TYPED[0] = (*_TYPED[0][:5], "a", "民事")


@query(rows_sql("path string, kind string, number string, level string, system string, subtype string", [t[1:] for t in _TYPED]))
def doc_type_detect(spark, sf):
    d = spark.createDataFrame([t[:2] for t in _TYPED], "text string, path string")
    t = F.col("text")
    n = extract.case_number(t)
    return d.select("path", extract.doc_type(t, F.col("path")).alias("kind"), n.alias("number"), extract.trial_level(t, n).alias("level"), extract.system_of_path(F.col("path")).alias("s")).select("path", "kind", "number", "level", "s.system", "s.subtype")


@query(rows_sql("court string, day string", [("某某县人民法院", "2023-05-06"), ("四川省高级人民法院", None)]))
def court_detect(spark, sf):
    d = spark.createDataFrame([("某某县 人民法院\n民事判决书\n（2023）川01民初12号\n二〇二三年五月六日",), ("本案由四川省高级人民法院审理",)], "text string")
    return d.select(extract.court(F.col("text")).alias("court"), extract.judgment_date(F.col("text")).alias("day"))


@query(rows_sql("statutes string", [("《民法典》第一条|《民法典》第二条|《刑法》（2020修正）第三条第一款",)]))
def statute_cursor_extract(spark, sf):
    t = "依照《民法典》（以下简称本法）第一条、第二条，《刑法》（2020修正）第三条第一款，《买卖合同》第九条，《民法典》第一条之规定"
    return extract.statutes(spark.createDataFrame([("d", t)], "doc_id string, text string")).select(F.array_join("statutes", "|").alias("statutes"))


_AMENDING = [
    ("d1", "某市关于修改《甲条例》的决定 一、修改《乙条例》 二、对《丙条例》作出修改 （一）《丁条例》 将第三条修改为：…… （二）《戊条例》 不变", "《甲条例》|《乙条例》|《丙条例》|《丁条例》", ""),
    ("d2", "决定废止下列法规：一、《己条例》二、《庚 条例》，《庚条例》。《关于废止某法的决定》", "", "《己条例》|《庚 条例》"),
]


@query(rows_sql("doc_id string, modified string, repealed string", [(a, c, d) for a, _, c, d in _AMENDING]))
def amended_repealed_laws(spark, sf):
    d = spark.createDataFrame([(a, b) for a, b, _, _ in _AMENDING], "doc_id string, text string")
    return d.select("doc_id", F.array_join(extract.amended_laws(F.col("text")), "|").alias("modified"), F.array_join(extract.repealed_laws(F.col("text")), "|").alias("repealed"))


_SORTED = [
    ("a", "买卖合同", "采购货物，交货后验收", "buy_sell"), ("b", "保密协议", "保密信息由披露方交给接收方", "nda"), ("c", "保密协议", "保密信息，投保人，接收方", "uncertain"),
    ("d", "合同", "租赁", "uncertain"), ("e", "房屋租赁合同", "租金与押金", "lease"), ("f", None, None, "uncertain"),
]


@query(rows_sql("id string, label string", [(a, d) for a, _, _, d in _SORTED]))
def nda_gate(spark, sf):
    d = spark.createDataFrame([x[:3] for x in _SORTED], "id string, title string, body string")
    return extract.classify(d).select("id", "label")


@query(rows_sql("label string, n long", [("buy_sell", 1), ("labor", 0), ("lease", 1), ("nda", 1), ("outsourcing", 0), ("software", 0), ("uncertain", 3)]))
def label_histogram(spark, sf):
    d = spark.createDataFrame([x[:3] for x in _SORTED], "id string, title string, body string")
    return extract.label_histogram(extract.classify(d), sorted(extract.KEYWORDS))


_TRIAL = "被告人张某，男。\n被告人李四，女。\n判决如下：\n一、被告人张某犯盗窃罪，判处有期徒刑三年六个月，缓刑四年，并处罚金人民币五千元；\n二、被告人李四犯诈骗罪，判处无期徒刑。"


@query(rows_sql("name string, offence string, term string, months long, fine long, probation boolean", [("张某", "盗窃罪", "三年六个月", 42, 5000, True), ("李四", "诈骗罪", "无期徒刑", -1, -1, False)]))
def disposition_parse(spark, sf):
    d = spark.createDataFrame([("d", _TRIAL)], "doc_id string, text string")
    return extract.dispositions(d, extract.defendants(d)).select("name", "offence", "term", F.coalesce("months", F.lit(-1)).alias("months"), F.coalesce("fine", F.lit(-1)).alias("fine"), "probation")


@query(rows_sql("name string, factor string, holds boolean", [("张某", "confession", True), ("张某", "self_surrender", False), ("李四", "confession", True), ("李四", "plead_guilty", True)]))
def factor_flags(spark, sf):
    d = spark.createDataFrame([("d", _TRIAL, "张某的行为不构成自首。李四认罪认罚。两被告人均坦白。")], "doc_id string, text string, opinion string")
    return extract.factors(d, extract.defendants(d)).select("name", "factor", "holds")


@query(rows_sql("summary string, focus string", [("本院认为，依法构成自首。|系从犯。", "本案争议焦点是自首。|辩护人认为不当。")]))
def opinion_sentences(spark, sf):
    d = spark.createDataFrame([("天气晴好。系从犯。本院认为，依法构成自首。", "本案争议焦点是自首。辩护人认为不当。无关。")], "o string, f string")
    return d.select(F.array_join(extract.opinion_summary(F.col("o"), 2), "|").alias("summary"), F.array_join(extract.dispute_focus(F.col("f"), F.lit("")), "|").alias("focus"))


@query(rows_sql("line string", [("序号：1；名称：甲；备注：红；大",), ("序号：2；名称：乙；备注：蓝",)]))
def linearize_table(spark, sf):
    rows = [["序号", "名称", "备注"], ["1", "甲", "红"], ["", "", "大"], ["2", "乙", "蓝"]]
    d = spark.createDataFrame([(rows,)], "rows array<array<string>>").where(pages.probable_table(F.col("rows")))
    return d.select(F.explode(pages.linearize(F.col("rows"))).alias("line"))


@query(rows_sql("text string, cell string", [("- [x] 固定价\n- [ ] 其他\n- [x] 固定总价合同\n共计壹佰元\n  - [x] 乙\n无", "买卖合同")]))
def checkbox_repair(spark, sf):
    d = spark.createDataFrame([("☑ 固定价\n☐其他：\n☐ 固定总价合同\n共计壹佰元\n  ☐ 乙\n✓\n无", "买买卖卖合合同同")], "t string, c string")
    return d.select(pages.checkbox_lines(F.col("t")).alias("text"), pages.cell(F.col("c")).alias("cell"))


@query(rows_sql("label string, n long", [("甲", 0), ("乙", 1), ("丙", 2), ("丁", 3)]))
def label_tree_flatten(spark, sf):
    tree = {"code": 0, "data": [{"label": "甲", "children": [{"label": "乙", "childrens": [{"label": "丙"}, {"label": "甲"}]}]}, {"label": "丁"}]}
    return spark.createDataFrame(list(zip(complete.flatten_labels(tree, unique=True), range(9))), "label string, n long")


@query(rows_sql("raw string, found string", [('```json\n{"a": 1}\n```', '{"a": 1}'), ('说明 [{"x": "}"}] 完', '{"clauses": [{"x": "}"}]}'), ("无", None)]))
def json_recover(spark, sf):
    import json

    raws = ['```json\n{"a": 1}\n```', '说明 [{"x": "}"}] 完', "无"]
    return spark.createDataFrame([(r, json.dumps(x) if (x := complete.recover_json(r)) is not None else None) for r in raws], "raw string, found string")


_RULES = [("r1", (["t1"], None, None, None)), ("r2", (None, ["甲", "乙"], None, None)), ("r3", (None, None, ["丙"], ["^丁.*戊$"]))]
_TEXTS = [("d", 1, "c1", "甲和乙", ["t1"]), ("d", 2, "c2", "丁己戊", []), ("d", 3, "c3", "丙甲", None)]


@query(rows_sql("id string, present boolean, sources string", [("r1", True, "c1"), ("r2", True, "c1"), ("r3", True, "c2,c3")]))
def rule_presence(spark, sf):
    rules = spark.createDataFrame(_RULES, "id string, rule struct<tags:array<string>,all:array<string>,any:array<string>,regex:array<string>>")
    c = spark.createDataFrame(_TEXTS, "doc_id string, order int, clause_id string, text string, clause_type array<string>")
    return presence.rule_presence(c, rules).select("id", "present", F.array_join("sources", ",").alias("sources"))


@query(rows_sql("doc_id string, clauses string", [("d", "c1:甲和乙|c2:改"), ("e", "c9:全文")]))
def seed_clause_backfill(spark, sf):
    g = spark.createDataFrame([("d", [("c1", " "), ("c2", "改")]), ("e", [])], "doc_id string, clauses array<struct<clause_id:string,text:string>>")
    s = spark.createDataFrame([("d", "c1", "甲和乙"), ("d", "c2", "原"), ("e", "c9", "全文")], "doc_id string, clause_id string, text string")
    got = presence.backfill_clauses(g, s)
    return got.select("doc_id", F.array_join(F.transform("clauses", lambda c: F.concat(c["clause_id"], F.lit(":"), c["text"])), "|").alias("clauses"))


_STAGES = [("一审", "Organization", "first_instance", "company"), ("再审", "natural_person", "retrial", "natural_person"), ("二审", "club", "second_instance", "other"), (None, None, "first_instance", "other")]


@query(rows_sql("level string, stage string, party string", [(a, c, d) for a, _, c, d in _STAGES]))
def graph_normalize(spark, sf):
    d = spark.createDataFrame([x[:2] for x in _STAGES], "level string, party string")
    return d.select("level", presence.procedure_stage(F.col("level")).alias("stage"), presence.party_type(F.col("party")).alias("party"))


@query(rows_sql("case_id string, missing string", [("a", "evidence"), ("b", "")]))
def soft_completeness(spark, sf):
    d = spark.createDataFrame([("a", "有证据证明", [], ["x"]), ("b", "无", [], [])], "case_id string, raw_text string, evidence array<string>, parties array<string>")
    return d.select("case_id", F.array_join(presence.mentioned_but_empty(F.col("raw_text"), {"evidence": ("证据", F.col("evidence")), "parties": ("原告|被告", F.col("parties"))}), ",").alias("missing"))


@query(rows_sql("chunk_id string", [("a",), ("c",)]))
def section_whitelist(spark, sf):
    d = spark.createDataFrame([("a", "理由", ["x"]), ("b", "尾部", ["x"]), ("c", "", ["x", "y"]), ("d", "理由", ["z"])], "chunk_id string, section string, clause_type array<string>")
    return rawinput.of_types(rawinput.wanted_sections(d, ["理由", "主文"]), ["x"]).select("chunk_id")
