"""Operators that no registered query covers, odd rows, and bounds of what is broadcast."""

from __future__ import annotations

import json
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from quillmill.functions import profiles
from quillmill.operators import blocks, complete, extract, link, merge, pages, presence, segment, vector
from quillmill.sources import readers, writers
from quillmill.streaming import incremental

# --- values ---


def test_presence_items_are_complete(spark):
    rows = presence.item_rows(spark).collect()
    count = {}
    for r in rows:
        count[r.contract_type] = count.get(r.contract_type, 0) + 1
        assert r.label and " " not in r.id
    assert count == {"buy_sell": 13, "lease": 12, "labor": 12, "nda": 11, "outsourcing": 13, "software": 13}
    assert sum(r.required for r in rows) == 54
    assert len(profiles.UNCITABLE_NAMES) == len(set(profiles.UNCITABLE_NAMES)) == 59


# --- small sides ---


def test_blocks_hold_each_row_once(spark):
    rows = spark.range(100).withColumnRenamed("id", "k")
    parts = blocks.blocks(rows, "k", 16)
    assert len(parts) == 7 and sorted(r.k for p in parts for r in p.collect()) == list(range(100))
    assert len(blocks.blocks(rows.limit(0), "k")) == 1


def test_searches_do_not_depend_on_blocks(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    assert sorted(vector.top_k(e, q, block=3).collect()) == sorted(vector.top_k(e, q).collect())
    cents = vector.centroids(e)
    assert sorted(vector.nearest_centroid(e, cents, 0.4, block=3).collect()) == sorted(vector.nearest_centroid(e, cents, 0.4).collect())


# --- odd rows ---


@pytest.mark.parametrize("body", [None, "", " \n ", "无"])
def test_empty_texts_give_defined_results(spark, body):
    d = spark.createDataFrame([("d", body, "x")], "doc_id string, text string, n string")
    assert segment.articles(d).count() == 0
    assert segment.statute_chunks(d).count() == 0
    assert segment.sections(d.drop("n")).count() == (1 if body == "无" else 0)
    assert segment.contract_clauses(d).count() == (1 if body == "无" else 0)
    assert link.citations(d, "doc_id").count() == 0
    row = d.select(extract.doc_type(F.col("text"), F.lit(None)).alias("a"), extract.trial_level(F.col("text"), F.lit(None)).alias("b"), extract.court(F.col("text")).alias("c"), pages.checkbox_lines(F.col("text")).alias("e")).first()
    assert (row.a, row.b) == ("", "") and (row.c or "") == "" and row.e == (body or "")
    assert extract.statutes(d).first().statutes == []


def test_merge_keeps_odd_rows(spark):
    old = spark.createDataFrame([(1, "a"), (None, "z"), (2, None)], "k long, v string")
    new = spark.createDataFrame([(2, "b"), (3, None), (None, "y")], "k long, v string")
    got = {r.k: r.v for r in merge.merge_upsert(old, new, ["k"], {}).collect()}
    assert got == {1: "a", 2: "b", 3: None}
    assert merge.merge_upsert(old.limit(0), new.limit(0), ["k"], {}).count() == 0
    with pytest.raises(ValueError):
        merge.merge_upsert(old, new, ["k"], {"v": "other"})


def test_party_lines(spark):
    lines = ["原告：张三，男。", "被告李四", "原告诉称，应当返还。", "原告，诉称应当返还。", "第三人", "天气晴好"]
    d = spark.createDataFrame([(x,) for x in lines], "line string")
    assert [r[0] for r in d.select(segment.is_party(F.col("line"))).collect()] == [True, True, False, False, True, False]


def test_trial_levels_take_codes_before_special_codes_and_the_body(spark):
    # 赔监 is a case code, which counts before the special code 委赔监
    rows = [("（2023）川知民终12号", "二审"), ("（2020）最高法刑复5号", "死刑复核"), ("（2021）川委赔监3号", "再审审查"), ("（2021）川委赔3号", "赔偿委员会决定"), ("（2021）川01执异34号", "执行程序")]
    d = spark.createDataFrame(rows, "no string, want string")
    for r in d.select("want", extract.trial_level(F.lit("本判决为一审"), F.col("no")).alias("got")).collect():
        assert r.got == r.want


def test_sections_of_clauses_carry_their_parent(spark):
    d = spark.createDataFrame([("d", 1, "第一条", "标的"), ("d", 2, "1.1", "数量"), ("d", 3, "第二条", "价款")], "doc_id string, order long, clause_no string, title string")
    rows = segment.with_parents(d).orderBy("order").collect()
    assert [(r.level, r.parent_section) for r in rows] == [(1, "第一条 标的"), (2, "第一条 标的"), (1, "第二条 价款")]
    assert rows[1].section_path == ["第一条 标的", "1.1 数量"]


# --- model calls and schemas ---


def test_paced_calls_wait_and_try_again():
    waits, calls = [], []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise OSError("busy")
        return "ok"

    assert complete.Paced(flaky, sleep=waits.append)("p") == "ok" and waits == [1, 3]

    def refuses(_):
        raise PermissionError

    with pytest.raises(PermissionError):
        complete.Paced(refuses, sleep=waits.append)("p")


def test_failed_calls_are_error_rows(spark):
    def make():
        def down(_):
            raise TimeoutError("late")

        return down

    d = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    good, bad = complete.split_errors(complete.extract_graphs(d, make, lambda t: t, lambda x: []))
    assert good.count() == 0 and [r.errors for r in bad.collect()] == [["TimeoutError: late"]] * 2


def test_strict_schemas_have_no_faults():
    raw = {"title": "T", "type": "object", "properties": {"a": {"type": "string", "minLength": 1}, "b": {"type": "object"}, "c": {"allOf": [{"$ref": "#/$defs/D"}]}}, "required": ["a"], "$defs": {"D": {"type": "object", "properties": {"x": {"type": "integer"}}}}}
    got = complete.strict_schema(raw)
    assert complete.lint_strict(got) == []
    assert got["required"] == ["a", "b", "c"] and "title" not in got and "minLength" not in json.dumps(got)
    assert "#/$def/D" in json.dumps(got) and "$defs" not in json.dumps(got)


# --- files and streams ---


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"doc_id": 1, "text": "x"}\n\n{"doc_id": 2, "text": null}\n')
    (tmp_path / "in/b.txt").write_text("正文")
    (tmp_path / "in/~$c.txt").write_text("lock")
    (tmp_path / "ids").write_text("# note\n\n7 \n8\n")
    rows = readers.json_lines(spark, f"{tmp_path}/in", "doc_id long, text string", "*.jsonl").collect()
    assert sorted(r.doc_id for r in rows) == [1, 2]
    assert [r.text for r in readers.texts(spark, f"{tmp_path}/in").collect()] == ["正文"]
    assert sorted(r.id for r in readers.ids(spark, f"{tmp_path}/ids").collect()) == ["7", "8"]
    (tmp_path / "in/bad.jsonl").write_text("{broken\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.json_lines(spark, f"{tmp_path}/in/bad.jsonl", "doc_id long").collect()
    table = f"{tmp_path}/table"
    assert writers.version(spark, table) == 0 and writers.current(spark, table, "k long").count() == 0
    assert writers.publish(spark.range(3), table) == 1 and writers.publish(spark.range(5), table) == 2
    assert writers.current(spark, table).count() == 5


def test_streamed_batches_merge_into_a_table(spark, tmp_path):
    source, table, at = f"{tmp_path}/source", f"{tmp_path}/table", f"{tmp_path}/at"

    def arrive(rows):
        spark.createDataFrame(rows, "k long, v string, seq long").coalesce(1).write.mode("append").parquet(source)
        stream = incremental.follow(spark, source, "k long, v string, seq long")
        incremental.upsert_stream(stream, table, at, ["k"], "seq", {}).awaitTermination()
        return {r.k: r.v for r in writers.current(spark, table).collect()}

    assert arrive([(1, "a", 1), (1, "b", 2), (2, "c", 1)]) == {1: "b", 2: "c"}
    assert arrive([(2, "d", 3), (3, "e", 3)]) == {1: "b", 2: "d", 3: "e"}


# --- the entry without the subpackage ---


def test_entry_imports_without_the_subpackage(tmp_path):
    import os
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/quillmill", tmp_path / "quillmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    n, m = map(int, said.stdout.split())
    assert n >= 80 and m >= 75 and not any(k.startswith("op1_") for k in said.stdout.split())


def test_json_shapes_and_encodings(spark, tmp_path):
    from quillmill.sources import readers

    (tmp_path / "a.json").write_text('{"a": 1}\n\n{"a": 2}\n{"a": 3}\n')
    (tmp_path / "b.json").write_text('[\n {"a": 4},\n {"a": 5}]')
    (tmp_path / "c.json").write_text('{\n "a": 6}')
    (tmp_path / "d.json").write_text('{"code": 0, "data": [{"a": 7}, {"a": 8}]}')
    read = lambda name, **how: sorted(r.a for r in readers.json_any(spark, f"{tmp_path}/{name}.json", "a int", **how).collect())
    assert (read("a"), read("b"), read("c"), read("d", envelope="data"), read("c", envelope="data")) == ([1, 2, 3], [4, 5], [6], [7, 8], [6])
    (tmp_path / "t").mkdir()
    (tmp_path / "t/x.txt").write_bytes("中文".encode("gb18030"))
    (tmp_path / "t/y.txt").write_bytes("é".encode())
    (tmp_path / "t/~$z.txt").write_bytes(b"no")
    assert sorted(r.text for r in readers.texts(spark, f"{tmp_path}/t").collect()) == ["é", "中文"]
    (tmp_path / "l").mkdir()
    (tmp_path / "l/x.jsonl").write_text('{"a": 1}\n')
    assert readers.json_lines(spark, [f"{tmp_path}/l", f"{tmp_path}/l/x.jsonl", f"{tmp_path}/l/"], "a int").count() == 1


def test_long_ranges_and_short_names_are_whole(spark):
    from pyspark.sql import functions as F

    from quillmill.functions.numerals import expand_articles
    from quillmill.operators import link

    row = spark.range(1).select(F.size(expand_articles(F.lit("第一条至第二万条"))).alias("n")).first()
    assert row.n == 20_000
    t = spark.createDataFrame([("t", "某法", None, "1")], "chunk_id string, law_name string, law_alias array<string>, article_no string")
    assert {r.key for r in link.target_keys(t).collect()} == {"某法", "法"}


def test_refined_sections_keep_every_line_in_order():
    import random

    from quillmill.operators.judgment import refined

    lines = ["（2023）川01民初12号", "原告：张三，男。", "被告：李四。", "本院于三月受理后", "诉讼请求：", "返还一百元。", "", "本院认为", "执行", "第三人请求", "民事判决书", "依照《民法典》"]
    rng = random.Random(5)
    for _ in range(400):
        body = "\n".join(rng.choices(lines, k=rng.randint(0, 9)))
        for name in ("案号行", "当事人信息", "理由"):
            parts = refined(name, body)
            assert "".join("".join(t.split()) for _, t in parts) == "".join(body.split())
            assert all(t == t.strip() and t for _, t in parts)


def test_parties_merge_what_can_be_one_person():
    from quillmill.operators.judgment import party_list

    found = party_list("被告人张某，男，住甲村。\n被告人张某，因犯盗窃罪于2010年3月4日被判处。被告人张某，女。\n被告张某，男。\n" + "被告人张某，男。\n" * 3)
    assert [(p["name"], p["role"], p["gender"], len(p["prior_convictions"])) for p in found] == [("张某", "被告人", "男", 1), ("张某", "被告人", "女", 0), ("张某", "被告", "男", 0)]
    assert party_list("") == [] and party_list("本院认为。") == []


def test_top_k_of_ties_nulls_other_lengths_and_empty_sides(spark):
    v = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.5, 0.5]), ("n", None), ("h", [1.0, None]), ("x", [9.0]), (None, [9.0, 9.0]), ("nan", [float("nan"), 0.0])], "vec_id string, embedding array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [2.0])], "query_id long, query array<double>")
    got = [tuple(r) for r in vector.top_k(v, q, 2).orderBy("query_id", "rank").collect()]
    assert got == [(1, "a", 1.0, 1), (1, "b", 1.0, 2), (2, "c", 0.5, 1), (2, "a", 0.0, 2), (4, "x", 18.0, 1)]
    assert vector.top_k(v.limit(0), q).isEmpty() and vector.top_k(v, q.limit(0)).isEmpty()


def test_top_k_matches_brute_force_over_many_packs(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.integers(-3, 4, (3000, 4)).astype(float)  # many ties
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    q = v.where("vec_id % 2 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in vector.top_k(v, q, 3, block=1).collect()}
    s = x @ x.T
    want = {(i, n + 1): (int(j), float(s[i, j])) for i in range(0, 3000, 2) for n, j in enumerate(np.lexsort((np.arange(3000), -s[i]))[:3])}
    assert got == want


def test_spans_of_any_length_match_their_articles(spark):
    from quillmill.operators import link

    spans = [("a", "1~3"), ("b", "第5条~第2000000000条"), ("c", "100~116"), ("d", "7"), ("e", "9~8"), ("f", None), ("g", "31~64")]
    targets = spark.createDataFrame([(i, "statute", "甲法", None, s) for i, s in spans], "chunk_id string, doc_type string, law_name string, law_alias array<string>, article_no string")
    asked = [*range(0, 130), 1_999_999_999, 2_000_000_000, 2_000_000_001]
    cited = spark.createDataFrame([(f"q{n}", "甲法", n) for n in asked] * 2, "chunk_id string, law_norm string, article long")
    edges, missed = link.cite_edges(cited, targets)
    bounds = {"a": (1, 3), "b": (5, 2_000_000_000), "c": (100, 116), "d": (7, 7), "g": (31, 64)}
    want = {(f"q{n}", t) for n in asked for t, (lo, hi) in bounds.items() if lo <= n <= hi}
    found = [(r.from_chunk, r.to_chunk) for r in edges.collect()]
    assert len(found) == len(want) and set(found) == want
    assert sorted(r.article for r in missed.collect()) == [0, 0, 4, 4, 2_000_000_001, 2_000_000_001]
    assert link.cite_edges(cited, targets.limit(0))[0].isEmpty()


def test_lines_align_as_a_walk_over_all_detected_lines_does():
    import random

    from quillmill.operators.pages import align

    rng = random.Random(2)
    for _ in range(300):
        lines, found = (rng.choices(["a", "b", "c", ""], k=rng.randint(0, 8)) for _ in range(2))
        want, after = [], 0
        for key in lines:
            at = next((i for i in range(after, len(found)) if key and found[i] == key), None)
            want.append(at)
            after = after if at is None else at + 1
        assert align(lines, found) == want


def test_modes_of_a_model_are_tried_in_turn():
    from quillmill.operators import complete

    asked, waits = [], []

    def tool(prompt):
        asked.append("tool")
        raise OSError("no tools")

    def plain(prompt):
        asked.append("plain")
        return "" if len(asked) < 5 else '{"a": 1}'

    assert complete.first_json([tool, plain], sleep=waits.append)("p") == '{"a": 1}'
    assert asked == ["tool"] * 3 + ["plain"] * 2 and waits == [1.6, 2.56]
    assert complete.first_json([tool, lambda p: "no json"], sleep=waits.append)("p") == ""


def test_tool_files_of_three_shapes():
    import pytest

    from quillmill.operators import complete

    tool = {"type": "function", "function": {"name": "f", "parameters": {"type": "object"}}}
    assert all(complete.tool_of(x) == tool for x in (tool, [tool, {}], {"tools": [tool]}))
    for bad in ([], {}, {"tools": []}, {"type": "function", "function": {}}, "f", None, [3]):
        with pytest.raises(ValueError):
            complete.tool_of(bad)


def test_case_graph_keeps_what_the_answer_has():
    from quillmill.operators import complete

    g = complete.case_graph({"meta": {"court": "乙", "cause": None}, "summary": "s", "parties": "no list"}, {"doc_id": " ", "meta": {"court": "甲", "cause": "c", "trial_level": "再审"}}, "text")
    assert (g["case_id"], g["summary"], g["parties"], g["raw_text"]) == ("UNKNOWN_DOC", "s", [], "text")
    assert (g["meta"]["court"], g["meta"]["cause"], g["meta"]["case_type"], g["meta"]["procedure_stage"]) == ("乙", None, "c", "retrial")
    assert complete.for_output(g, "d")["raw_text"] == "" and complete.for_output(g, "d", True)["raw_text"] == "text"


def test_no_keys_of_targets_are_broadcast(spark, monkeypatch):
    from quillmill.operators import link

    targets = spark.range(40).selectExpr("concat('t', id) chunk_id", "'statute' doc_type", "concat('甲乙', id % 4, '法') law_name", "array('简称') law_alias", "concat(id % 7, '~', id % 7 + 2) article_no")
    cited = spark.range(60).selectExpr("concat('q', id % 45) chunk_id", "element_at(array('法', '甲乙1法', '简称', '乙法'), int(id % 4) + 1) law_norm", "id % 11 article")
    want = {(f"q{n % 45}", f"t{i}") for n in range(60) for i in range(40) if i % 7 <= n % 11 <= i % 7 + 2 and (n % 4 in (0, 2) or (n % 4 == 1 and i % 4 == 1))}
    for pairs in (0, 1000):
        monkeypatch.setattr(link, "PAIRS", pairs, raising=False)
        edges, missed = link.cite_edges(cited, targets)
        plan = edges._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan if pairs == 0 else all("BuildRight" not in line or "LeftSemi" in line for line in plan.splitlines() if "BroadcastHashJoin" in line)
        found = [(r.from_chunk, r.to_chunk) for r in edges.collect()]
        assert len(found) == len(want) and set(found) == want
        assert all(r.article > 8 or r.law_norm == "乙法" for r in missed.collect()) and missed.count() > 0


def test_citations_without_target_are_told_by_pairs_alone(spark):
    from quillmill.operators import link

    targets = spark.range(40).selectExpr("concat('t', id) chunk_id", "'statute' doc_type", "'甲法' law_name", "cast(null as array<string>) law_alias", "'1~5' article_no")
    cited = spark.range(20).selectExpr("concat('q', id) chunk_id", "'甲法' law_norm", "id article")
    missed = link.cite_edges(cited, targets)[1]
    anti = [line for line in missed._jdf.queryExecution().sparkPlan().toString().splitlines() if "LeftAnti" in line]
    assert len(anti) == 1 and "BroadcastHashJoin" in anti[0]  # a few pairs go out, and no target of theirs
    assert sorted(r.article for r in missed.collect()) == [0, *range(6, 20)]


def test_crowded_pages_make_no_pairs_of_ticks_and_boxes(spark, monkeypatch):
    import numpy as np

    from quillmill.operators import pages

    r = np.random.default_rng(3)
    ticks, boxes = ([(int(p), i, float(x), float(y)) for i, (p, x, y) in enumerate(zip(r.integers(0, 2, n), r.integers(-60, 300, n), r.integers(0, 15, n) * 20))] for n in (700, 900))
    ticks += [(0, 5000 + i, 50.0, 50.0) for i in range(3000)] + [(7, 1, 0.0, 0.0), (0, 4999, None, 1.0)]
    boxes += [(0, 5000 + i, 50.0 + i % 2, 50.0) for i in range(3000)]
    t, b = (spark.createDataFrame(rows, "page int, id long, x double, y double") for rows in (ticks, boxes))
    want = {}
    for page in (0, 1):
        own = np.array([q[1:] for q in boxes if q[0] == page])
        for _, i, x, y in (q for q in ticks if q[0] == page and q[2] is not None):
            d = np.sqrt((own[:, 1] - x) ** 2 + (own[:, 2] - y) ** 2)
            if d.min() < 25:
                want[page, i] = int(own[d.argmin(), 0])
    for part in (100_000, 500):
        monkeypatch.setattr(pages, "PART", part, raising=False)
        got = pages.nearest_within(t, b)
        joins = [line for line in got._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]
        assert len(joins) == 1 and "BroadcastHashJoin" in joins[0] and "LeftOuter" in joins[0]  # the parts of crowded tiles
        assert {(q.page, q.tick): q.box for q in got.collect()} == want


def test_each_distinct_trigram_is_hashed_once(monkeypatch):
    import hashlib

    import numpy as np

    from quillmill.operators import vector

    blake, calls = hashlib.blake2b, []
    monkeypatch.setattr(hashlib, "blake2b", lambda *a, **k: calls.append(1) or blake(*a, **k))
    texts = ["", "a", "ab", "abc", "\0\0\0\0", "\0", "某法第三条" * 50, "x\ud800y\U0010ffffz", "abcabc" * 1000]
    want = np.zeros((len(texts), 32), np.float32)
    for i, t in enumerate(texts):
        for j in range(max(len(t) - 2, 1)):
            h = int.from_bytes(blake(t[j : j + 3].encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")
            want[i, h % 32] += 1 if h >> 63 else -1
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-12)
    for points in (4_000_000, 7):
        monkeypatch.setattr(vector, "POINTS", points, raising=False)
        assert (vector.hash_embedder(32)(texts) == want).all()
    assert len(calls) <= 2 * len({t[j : j + 3] for t in texts for j in range(max(len(t) - 2, 1))})


def test_of_candidates_with_the_same_articles_one_is_ranked(spark):
    from pyspark.sql import functions as F

    from quillmill.operators import link

    rows = [(i, [1, 2] if i % 3 == 0 else [2, 1] if i % 3 == 1 else None, None if i % 5 == 0 else f"v{i % 2}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, doc_articles array<bigint>, version string")
    index = docs.select(F.lit("甲法").alias("name"), "doc_id", (F.col("doc_id") % 2 == 0).alias("by_alias"))
    asked = [(1, "甲法", [1, 2]), (2, "甲法", [9]), (3, "甲法", None), (4, "乙法", [1])]
    m = spark.createDataFrame([(i, n, n, a) for i, n, a in asked], "doc_id long, law_norm string, law_raw string, articles array<bigint>")
    got = link.best_target(m, index, docs)
    best = lambda a: min(rows, key=lambda r: (-len(set(a or []) & set(r[1] or [])), chr(999) if r[2] is None else chr(200 - ord(r[2][1])), r[0]))[0]
    want = {1: best([1, 2]), 2: best([9]), 3: best(None), 4: None}
    want_alias = {i: None if d is None else d % 2 == 0 for i, d in want.items()}
    assert {r.from_doc: r.to_doc for r in got.collect()} == want
    assert {r.from_doc: r.by_alias for r in got.collect()} == want_alias
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "min(struct(cand" in plan or "min(named_struct(cand" in plan
