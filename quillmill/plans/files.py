"""Queries that go through files: written to the shared folder and read again."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
import zlib

from pyspark.sql import functions as F

from ..operators import merge
from ..sources import readers, writers
from .registry import query, rows_sql, table


def scratch(spark) -> str:
    """A new folder below spark.checkpoint.dir, or a temporary one in a local session."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.sparkContext.master.startswith("local"):
        at = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_quillmill"
    return f"{(at or 'file://' + tempfile.mkdtemp()).rstrip('/')}/files-{uuid.uuid4().hex}"


@query("select doc_id, lang, length(text)::bigint as n, source from documents")
def jsonl_roundtrip(spark, sf):
    path = scratch(spark)
    writers.lines_by(table(spark, sf, "documents").select("doc_id", "lang", "text", "source"), path, "source")
    back = spark.read.schema("doc_id long, lang string, text string, source string").option("mode", "FAILFAST").json(path)
    return back.select("doc_id", "lang", F.length("text").cast("long").alias("n"), "source")


@query("select o_orderkey as doc_id, case when o_orderkey % 2 = 0 then 'late' else 'early' end as state, 2 as version from orders")
def versioned_upsert(spark, sf):
    path = scratch(spark)
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit("early").alias("state"))
    writers.publish(o, path)
    writers.publish(merge.merge_upsert(writers.current(spark, path), o.where("doc_id % 2 = 0").withColumn("state", F.lit("late")), ["doc_id"], {}), path, sort_by=["doc_id"])
    return writers.current(spark, path).withColumn("version", F.lit(writers.version(spark, path)))


@query("select 'ok' as side, count(*) filter (where l_quantity <= 25)::bigint as n from lineitem union all select 'errors', count(*) filter (where l_quantity > 25) from lineitem")
def error_side_output(spark, sf):
    path = scratch(spark)
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.when(F.col("l_quantity") > 25, "too many").alias("error"))
    writers.result_and_errors(rows, path)
    count = lambda s: spark.read.schema("l_orderkey long").json(f"{path}/{s}").select(F.lit(s).alias("side")).groupBy("side").agg(F.count("*").alias("n"))
    return count("ok").unionByName(count("errors"))


@query(rows_sql("name string, text string", [("utf8", "合同法"), ("gb", "民法典"), ("broken", "ab")]))
def decode_fallback(spark, sf):
    rows = [("utf8", bytearray("合同法".encode())), ("gb", bytearray("民法典".encode("gb18030"))), ("broken", bytearray(b"a\xffb"))]
    d = spark.createDataFrame(rows, "name string, content binary")

    def text(content):
        return readers.decode(bytes(content))

    return d.select("name", F.coalesce(readers.valid_utf8(F.col("content")), F.udf(text, "string")("content")).alias("text"))


def sample_docx() -> bytes:
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    t = lambda s: f"<w:p><w:r><w:t>{s}</w:t></w:r></w:p>"
    xml = f"<w:document {ns}><w:body>{t('第一条')}<w:tbl><w:tr><w:tc>{t('甲')}</w:tc><w:tc>{t('乙')}</w:tc></w:tr></w:tbl>{t('第二条')}</w:body></w:document>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", xml)
    return out.getvalue()


def sample_pdf() -> bytes:
    return b"%PDF-1.4\n1 0 obj\n<<>>\nstream\n" + zlib.compress(rb"BT (Clause \(1\)) Tj 0 -12 Td (next line) Tj ET") + b"\nendstream\nendobj\n"


@query(rows_sql("name string, text string", [("a.docx", "第一条\n第二条\n甲\t乙"), ("b.pdf", "Clause (1)\nnext line"), ("c.txt", "正文")]))
def document_readers(spark, sf):
    rows = [("a.docx", bytearray(sample_docx())), ("b.pdf", bytearray(sample_pdf())), ("c.txt", bytearray("正文".encode("gb18030")))]

    def text(name, content):
        return readers.any_text(name, bytes(content))

    return spark.createDataFrame(rows, "name string, content binary").select("name", F.udf(text, "string")("name", "content").alias("text"))


@query(rows_sql("path string, target string", [("x/a.txt", "l/a.txt"), ("y/a.txt", "l/a_(1).txt"), ("z/a.txt", "m/a.txt")]))
def collision_names(spark, sf):
    d = spark.createDataFrame([("x/a.txt", "l", "a.txt"), ("y/a.txt", "l", "a.txt"), ("z/a.txt", "m", "a.txt")], "path string, label string, name string")
    return writers.collision_names(d).select("path", "target")
