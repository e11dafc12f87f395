"""Readers of JSON lines, texts and documents."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _outermost(paths: list[str]) -> list[str]:
    """The paths without repeats and without those below another one."""
    own = sorted({p.rstrip("/") for p in paths})
    return [p for p in own if not any(p.startswith(f"{q}/") for q in own)]


def json_lines(spark: SparkSession, paths: str | list[str], schema: T.StructType | str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """Rows of JSON-lines files, each file once; a broken line is an error, blank lines are none."""
    r = spark.read.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", recursive)
    return (r.option("pathGlobFilter", pattern) if pattern else r).json(_outermost([paths] if isinstance(paths, str) else paths))


def json_any(spark: SparkSession, path: str, schema: T.StructType | str, envelope: str | None = None) -> DataFrame:
    """Rows of files that are each one JSON document, an array of such, or JSON lines.

    With an envelope, what its field holds, be it one row or an array; a document without that
    field is taken as it stands.
    """
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    kind = ddl if ddl.startswith("struct<") else f"struct<{ddl}>"
    value = F.col("value")
    lines = F.filter(F.split(value, "\n"), lambda x: F.trim(x) != "")
    whole = spark.read.text(path, wholetext=True)
    by_line = (F.size(lines) > 1) & F.forall(lines, lambda x: F.try_parse_json(x).isNotNull())  # each by itself
    each = whole.select(F.explode(F.when(by_line, lines).otherwise(F.array(value))).alias("v"))
    if envelope is not None:
        each = each.select(F.coalesce(F.get_json_object("v", f"$.{envelope}"), F.col("v")).alias("v"))
    several = F.from_json("v", f"array<{kind}>")
    rows = F.when(F.ltrim("v").startswith("["), several).otherwise(F.array(F.from_json("v", kind)))
    return each.select(F.explode(rows).alias("r")).select("r.*")


def texts(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """(path, name, size, text) of whole text files below a folder, decoded, lock files left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    files = files.where(~F.col("path").rlike(r"/~\$[^/]*$")).select("path", F.regexp_extract("path", "[^/]+$", 0).alias("name"), F.col("length").alias("size"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([decode(x.as_py()) for x in b.column(3)], pa.string())], names=["path", "name", "size", "text"])

    return files.mapInArrow(run, "path string, name string, size long, text string")


def ids(spark: SparkSession, path: str) -> DataFrame:
    """(id): lines of a list, without comments and blank ones."""
    v = F.trim(F.col("value"))
    return spark.read.text(path).select(v.alias("id")).where((F.col("id") != "") & ~F.col("id").startswith("#"))


def tree(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, size) of all files below a folder, by name without regard to case."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", "[^/]+$", 0)
    return f.select("path", name.alias("name"), F.col("length").alias("size")).orderBy(F.lower("name"), "path")


def decode(content: bytes | None, encodings: tuple[str, ...] = ("utf-8", "gb18030")) -> str:
    """Text in the first encoding that fits; what no encoding reads is left out."""
    for e in encodings:
        try:
            return (content or b"").decode(e)
        except UnicodeDecodeError:
            continue
    return (content or b"").decode(encodings[0], "ignore")


def docx_text(content: bytes) -> str:
    """Paragraphs of a document, then the rows of its tables with cells parted by tabs."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{w}body")
    said = lambda e: "".join(t.text or "" for t in e.iter(f"{w}t"))
    paragraphs = [said(p) for p in body.findall(f"{w}p")]
    rows = ["\t".join(said(c) for c in r.findall(f"{w}tc")) for t in body.findall(f"{w}tbl") for r in t.findall(f"{w}tr")]
    return "\n".join([*paragraphs, *rows])


_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.S)
_SHOWN = re.compile(rb"\((?:[^()\\]|\\.)*\)|T\*|'|\bTd\b|\bTD\b|\bET\b")


def pdf_pages(content: bytes) -> list[str]:
    """Text shown by each content stream of a simple PDF, with plain or deflated streams and single-byte strings."""
    out = []
    for m in _STREAM.finditer(content):
        try:
            raw = zlib.decompress(m[1])
        except zlib.error:
            raw = m[1]
        if b"BT" not in raw:
            continue
        parts = []
        for s in _SHOWN.findall(raw):
            if s.startswith(b"("):
                parts.append(re.sub(rb"\\(.)", rb"\1", s[1:-1]).decode("latin-1"))
            elif parts and not parts[-1].endswith("\n"):
                parts.append("\n")
        out.append("".join(parts).strip())
    return out


def any_text(name: str, content: bytes) -> str:
    if name.lower().endswith(".docx"):
        return docx_text(content)
    if name.lower().endswith(".pdf"):
        return "\n\n".join(pdf_pages(content))
    return decode(content)


def documents(spark: SparkSession, path: str, pattern: str = "*.{txt,docx,pdf}") -> DataFrame:
    """(path, text, error): the text of each file, or why it could not be read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    got.append((any_text(name, content), None))
                except Exception as e:  # the broken file's result
                    got.append((None, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=["path", "text", "error"])

    return files.where(~F.col("path").rlike(r"/~\$[^/]*$")).mapInArrow(run, "path string, text string, error string")


def valid_utf8(content: Column) -> Column:
    """Text of bytes that are UTF-8, else null."""
    return F.try_validate_utf8(content.cast("string"))
