"""Queries of judgment records; their SQL gives the rows expected, for the tables hold no judgments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import complete, extract, judgment, link, pages, rawinput
from .registry import query, rows_sql, table

_COURTS = [
    ("民事判决书\n某某县人民法院\n甲市乙区人民法院", "某某县人民法院"),
    ("卷宗 甲县人民法院第一庭\n乙县人民法院赔偿委员会第一庭\n赔偿决定书", "甲县人民法院"),
    ("乙县人民法院赔偿委员会第一庭\n丙县人民法院第一庭\n赔偿决定书", "乙县人民法院赔偿委员会"),
    ("判决书\n请求甲县人民法院处理\n由乙县人民法院", "由乙县人民法院"),
    ("x\n甲县人民法院办\n乙县人民法院赔偿委员会办", "乙县人民法院赔偿委员会"),
    ("本院\n审理", ""),
    (None, ""),
]


@query(rows_sql("text string, court string", _COURTS))
def judgment_court(spark, sf):
    d = spark.createDataFrame([x[:1] for x in _COURTS], "text string")
    return d.select("text", judgment.ranked_court(F.col("text")).alias("court"))


_WHOLE = "某某县人民法院\n民事判决书\n（2023）川01民初12号\n依照《民法典》第一条、第二条，判决如下\n二〇二三年五月六日"
_META = [("a", "（2023）川01民初12号", "某某县人民法院", "2023-05-06", "民事判决书", "一审", "《民法典》第一条|《民法典》第二条"), ("b", "", "", "", "", "", "")]


@query(rows_sql("doc_id string, case_number string, court string, judgment_date string, doc_type string, trial_level string, statutes string", _META))
def judgment_light_meta(spark, sf):
    d = spark.createDataFrame([("a", _WHOLE), ("b", None)], "doc_id string, text string")
    return judgment.light_meta(d).withColumn("statutes", F.array_join("statutes", "|"))


_INTRO = (
    "公诉机关：某县人民检察院。\n被告人张某，男，1980年1月2日出生，住某县甲村。因犯盗窃罪于2010年3月4日被判处拘役三个月。\n"
    "被告人张某，于2020年5月6日被刑事拘留，同年逮捕；被告人张某，于2020年6月7日被逮捕。\n被告人张某，女，住某县乙村。\n"
    "原告（反诉被告）李四、王五等，住某市。\n第三人：赵六\n辩护人：钱七律师，某某律师事务所律师。\n辩护人：钱七律师，某某律师事务所律师。\n"
    "委托代理人：孙八，法律援助中心律师。\n检察员周九、吴十出庭支持公诉。张某甲在场。"
)
_PARTIES = [
    ("d", 0, "张某", "被告人", "男", "1980-01-02", "某县甲村", "2020-05-06", "2020-06-07", "张某甲"),
    ("d", 1, "张某", "被告人", "女", None, "某县乙村", None, None, "张某甲"),
    ("d", 2, "李四", "原告", None, None, "某市", None, None, None),
    ("d", 3, "王五", "原告", None, None, "某市", None, None, None),
    ("d", 4, "赵六", "第三人", None, None, None, None, None, None),
]


@query(rows_sql("doc_id string, seq long, name string, role string, gender string, dob string, address string, detained string, arrested string, aka string", _PARTIES))
def party_records(spark, sf):
    d = spark.createDataFrame([("d", _INTRO, "张某甲在场"), ("e", None, None)], "doc_id string, intro string, text string")
    return judgment.parties(d, text_col="text").drop("prior_convictions", "custody")


@query(rows_sql("office string, prosecutors string, lawyers string", [("某县人民检察院", "周九|吴十", "钱七:某某律师事务所|孙八:法律援助中心"), (None, "", "")]))
def judgment_counsel(spark, sf):
    d = spark.createDataFrame([(_INTRO,), (None,)], "intro string")
    i = F.col("intro")
    named = F.transform(judgment.lawyers(i), lambda x: F.concat_ws(":", x["name"], x["firm"]))
    return d.select(judgment.procuratorate(i).alias("office"), F.array_join(judgment.prosecutors(i), "|").alias("prosecutors"), F.array_join(named, "|").alias("lawyers"))


_RULED = "判决如下：\n一、被告人张某犯盗窃罪，判处有期徒刑一年，（刑期从2020年5月6日起至2021年5月5日止）。\n二、违法所得人民币三千元予以追缴。"


@query(rows_sql("name string, confiscation long, term_start string, term_end string", [("张某", 3000, "2020-05-06", "2021-05-05")]))
def disposition_terms(spark, sf):
    d = spark.createDataFrame([("d", "被告人张某，男。\n" + _RULED)], "doc_id string, text string")
    return extract.dispositions(d, extract.defendants(d)).select("name", "confiscation", "term_start", "term_end")


_SECTIONS = [
    ("d", 1, "案号行", "（2023）川01民初12号 原告：张三，男。\n被告：李四。\n本院于三月受理后，组成合议庭。"),
    ("d", 2, "当事人信息", "原告：张三。\n诉讼请求：\n返还一百元。\n被告李四辩称：\n没有。"),
    ("d", 3, "理由", "本院认为\n证据不足。"),
    ("d", 4, "案号行", "（2023）川01民初13号"),
    ("d", 5, "当事人信息", None),
]
_REFINED = [
    ("d", 1, 0, "案号行", "（2023）川01民初12号"),
    ("d", 1, 1, "当事人信息", "原告：张三，男。\n被告：李四。"),
    ("d", 1, 2, "审理经过", "本院于三月受理后，组成合议庭。"),
    ("d", 2, 0, "当事人信息", "原告：张三。"),
    ("d", 2, 1, "诉讼请求", "诉讼请求：\n返还一百元。"),
    ("d", 2, 2, "答辩意见", "被告李四辩称：\n没有。"),
    ("d", 3, 0, "理由", "本院认为\n证据不足。"),
    ("d", 4, 0, "案号行", "（2023）川01民初13号"),
]


@query(rows_sql("doc_id string, seq long, part long, section string, text string", _REFINED))
def embedded_sections(spark, sf):
    return judgment.refine_sections(spark.createDataFrame(_SECTIONS, "doc_id string, seq long, section string, text string"))


_CHUNKS = [
    ("d", 2, "理由", "本院认为被告人自首。争议焦点为是否自首。"),
    ("d", 1, "当事人信息", "公诉机关某县人民检察院。\n辩护人：钱七，某某律师事务所律师。"),
    ("d", 0, "标题", "刑事判决书"),
    ("e", 0, "正文", None),
]


@query(rows_sql("doc_id string, procuratorate string, lawyers long, dispute_focus string, opinion_summary string", [("d", "某县人民检察院", 1, "争议焦点为是否自首。", "本院认为被告人自首。争议焦点为是否自首。"), ("e", None, 0, "", "")]))
def criminal_record(spark, sf):
    r = judgment.criminal_records(spark.createDataFrame(_CHUNKS, "doc_id string, chunk_index long, section string, text string"))
    return r.select("doc_id", "procuratorate", F.size("lawyers").cast("long").alias("lawyers"), F.array_join("dispute_focus", "").alias("dispute_focus"), F.array_join("opinion_summary", "").alias("opinion_summary"))


@query("""
select conv_id, turn, case when row_number() over (partition by conv_id order by turn) = 1 then n end::bigint as attached, n as everywhere
from conversations left join (select conv_id, count(*)::bigint as n from conversations where conv_id % 3 <> 0 group by conv_id) using (conv_id)
""")
def attach_document_info(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn")
    info = c.where("conv_id % 3 <> 0").groupBy("conv_id").agg(F.count("*").alias("n"))
    one = judgment.attach(c, info, "conv_id", "turn").withColumnRenamed("judgment_info", "one")
    return judgment.attach(one, info, "conv_id", "turn", everywhere=True).select("conv_id", "turn", F.col("one.n").alias("attached"), F.col("judgment_info.n").alias("everywhere"))


@query("""
select conv_id, string_agg(t, chr(10) || chr(10) || chr(10) order by turn) as text, array_to_string(list(turn::varchar order by turn), ',') as chunk_ids, array_to_string(list(role order by turn), ',') as sections
from (select *, trim(text, ' ' || chr(9) || chr(10) || chr(13)) as t from conversations) where t <> '' and (coalesce(role, '') = '' or role in ('user', 'assistant')) group by conv_id
""")
def document_texts(spark, sf):
    got = rawinput.joined_chunks(table(spark, sf, "conversations"), "conv_id", "turn", "turn", "role", wanted=["user", "assistant"])
    return got.select("conv_id", "text", F.array_join(F.col("chunk_ids").cast("array<string>"), ",").alias("chunk_ids"), F.array_join("sections", ",").alias("sections"))


_LINES = [(1, 0, "a"), (1, 1, "b"), (1, 2, "a"), (1, 3, "c"), (1, 4, "b"), (1, 5, ""), (2, 0, "a")]
_DETECTED = [(1, 0, "x", True), (1, 1, "b", True), (1, 2, "a", False), (1, 3, "b", True), (1, 4, "", True)]
_ALIGNED = [(1, 0, False), (1, 1, True), (1, 2, False), (1, 3, False), (1, 4, False), (1, 5, False), (2, 0, False)]


@query(rows_sql("page long, n long, checked boolean", _ALIGNED))
def checkbox_alignment(spark, sf):
    d = spark.createDataFrame(_DETECTED, "page long, n long, key string, checked boolean")
    return pages.aligned_lines(spark.createDataFrame(_LINES, "page long, n long, key string"), d)


_ITEMS = [
    '{"law": "《民法典》", "articles": [1, "第三条", {"start": "第五条", "end": "七"}], "article_no": "第九条至第十条"}',
    '{"name": "中华人民共和国民法典", "article": {"l": 0, "r": 12, "x": 3}}',
    "依照《刑法》第十二条",
    '"《刑法》第十四条至第十五条"',
    '{"title": "无条法"}',
    '{"article": 3}',
    None,
    "",
]
_STRUCTURED = [("d", "民法典", "中华人民共和国民法典", "1,3,5,6,7,9,10,12"), ("d", "刑法", "刑法", "12,14,15")]


@query(rows_sql("doc_id string, law_norm string, law_raw string, articles string", _STRUCTURED))
def structured_citations(spark, sf):
    m = link.structured_mentions(spark.createDataFrame([("d", _ITEMS), ("e", None)], "doc_id string, items array<string>"))
    return m.withColumn("articles", F.array_join(F.col("articles").cast("array<string>"), ","))


_GRAPHS = [("a", "a", "judgment", "second_instance", "甲法院", 1, ""), ("b", "B", "judgment", "first_instance", None, 0, "")]


@query(rows_sql("doc_id string, case_id string, source string, stage string, court string, facts long, raw_text string", _GRAPHS))
def case_graph_defaults(spark, sf):
    answers = spark.createDataFrame([("a", '{"facts": ["x"], "claims": 3}'), ("b", '{"case_id": "B", "facts": null, "source_type": "other"}'), ("c", None), ("e", "{}")], "doc_id string, payload string")
    docs = spark.createDataFrame([("a", '{"meta": {"trial_level": "二审", "court": "甲法院"}}', "t"), ("b", None, None), ("c", "{}", "t")], "doc_id string, doc string, text string")
    g = lambda path: F.get_json_object("payload", f"$.{path}")
    facts = F.json_array_length(g("facts")).cast("long")
    return complete.case_graphs(answers, docs).select("doc_id", g("case_id").alias("case_id"), g("source_type").alias("source"), g("meta.procedure_stage").alias("stage"), g("meta.court").alias("court"), facts.alias("facts"), g("raw_text").alias("raw_text"))
