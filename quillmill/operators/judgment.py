"""Records of judgments: the head's facts, parties and counsel, sections inside sections, whole criminal records."""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import profiles
from ..functions.numerals import let
from ..functions.text import repair_citations, strip, text
from . import extract

_LINE_ENDS = r"[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def ranked_court(body: Column, reach: int = 100) -> Column:
    """The court that the first filled lines name, empty for none.

    A line that is a court's name alone wins; then the topmost name in the five lines above the kind
    of judgment; then the name of the best line, by place, end of line, first words and length.
    A compensation committee goes before a court nearby, or among the best five.
    """
    lines = F.filter(F.transform(F.split(text(body), _LINE_ENDS), strip), lambda x: x != "")
    return let(F.slice(lines, 1, reach), _court_of)


def _court_of(lines: Column) -> Column:
    kind = F.array_position(F.transform(lines, lambda x: x.rlike(profiles.KINDS_OF_JUDGMENT)), F.lit(True)).cast("int") - 1
    seen = F.transform(lines, lambda x, i: F.struct(i.alias("i"), F.regexp_extract(x, profiles.COURT, 0).alias("name"), x.alias("line")))
    is_committee = lambda c: c["name"].endswith(profiles.COMMITTEE)
    first = lambda found: F.get(found, F.lit(0))

    def points(c: Column) -> Column:
        n, early = F.length(c["name"]), F.lit(profiles.COURT_LATE)
        for last, ahead in reversed(profiles.COURT_EARLY):
            early = F.when(c["i"] <= last, ahead).otherwise(early)
        late = F.when(c["line"].rlike(f"^(?:{profiles.NARRATIVE_STARTS})"), 10).otherwise(0)
        behind = late - early - F.when(c["line"].endswith(c["name"]), 5).otherwise(0) - F.when(is_committee(c), 10).otherwise(0)
        return F.struct((behind + F.abs(n - 10) * 0.5).alias("points"), c["i"].alias("i"), n.alias("n"), c["name"].alias("name"))

    def choose(named: Column) -> Column:
        alone = first(F.filter(lines, lambda x: x.rlike(f"^{profiles.COURT}$")))
        above = first(F.filter(named, lambda c: (c["i"] < kind) & (c["i"] >= kind - 5)))
        near = first(F.filter(named, lambda c: is_committee(c) & c["i"].between(above["i"] - 2, above["i"])))
        best = F.slice(F.array_sort(F.transform(named, points)), 1, 5)
        return F.coalesce(alone, near["name"], above["name"], first(F.filter(best, is_committee))["name"], first(best)["name"], F.lit(""))

    return let(F.filter(seen, lambda c: c["name"] != ""), choose)


META = "doc_id string, case_number string, court string, judgment_date string, doc_type string, trial_level string, statutes array<string>"


def light_meta(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """One row of META for each row of docs; what is not found is empty.  One pass, no shuffle."""
    t = F.col(text_col)
    number = extract.case_number(t)
    path = F.col(path_col) if path_col else F.lit("")
    own = docs.select(F.col(id_col).cast("string").alias("doc_id"), number.alias("case_number"), ranked_court(t).alias("court"), F.coalesce(extract.judgment_date(t), F.lit("")).alias("judgment_date"), extract.doc_type(t, path).alias("doc_type"), extract.trial_level(t, number).alias("trial_level"), repair_citations(t).alias("statutes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cited = pa.array([extract.statute_list(x) for x in b.column("statutes").to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], cited], names=b.schema.names)

    return own.mapInArrow(run, META)


# --- parties and counsel ---

PARTIES = "doc_id string, seq long, name string, role string, aka string, gender string, dob string, address string, prior_convictions array<string>, detained string, arrested string, custody string"
_HAN = "一-龥"
_ROLE = re.compile(rf"({profiles.PARTY_CALLED})(?:（[^）]{{0,40}}）)?\s*[:：]?\s*(.+)", re.S)
_NAMES = re.compile(rf"[{_HAN}·]{{1,4}}(?:[、和及与][{_HAN}·]{{1,4}})*(?=[，,；;、。\s（）()男女]|$)")
_HELD, _CONVICTED = re.compile(profiles.HELD), re.compile(profiles.CONVICTED)
_SINGLE = ("gender", "dob", "address")


def _said(patterns: tuple[str, ...], sentence: str) -> str | None:
    return next((m[1].strip() for p in patterns if (m := re.search(p, sentence))), None)


def _iso(day: str | None) -> str | None:
    """ISO date of a date in figures; null for none, or one that the calendar does not have."""
    try:
        return datetime.date(*map(int, re.findall("[0-9]+", day or ""))).isoformat()
    except (TypeError, ValueError):
        return None


def _facts(sentence: str) -> dict:
    held = {profiles.HELD_AS[how]: _iso(day) for day, how in _HELD.findall(sentence)}
    return {
        "gender": _said(profiles.GENDER, sentence),
        "dob": _iso(_said(profiles.BORN, sentence)),
        "address": _said(profiles.LIVES, sentence) or None,
        "prior_convictions": _CONVICTED.findall(sentence),
        **dict.fromkeys(profiles.HELD_AS.values()),
        **held,
    }


def party_list(intro: str, full: str = "") -> list[dict]:
    """The parties of an introduction in order, one record for all sentences that can be on the same one.

    Sentences are on the same party if name and role agree, and no gender, birth or address
    contradicts.  What an earlier one says stays, later ones fill gaps and add convictions.  aka
    is what first follows the surname in the full text, unless that is the name.
    """
    known: dict[tuple[str, str], list[dict]] = {}
    for sentence in map(str.strip, re.split("[。；\n]", intro)):
        m = _ROLE.match(sentence)
        names = m and _NAMES.match(m[2])
        if not names:
            continue
        facts = _facts(sentence)
        for name in filter(None, map(str.strip, re.split("[、和及与]", re.sub("等人?$", "", names[0])))):
            same = known.setdefault((name, m[1]), [])
            mine = next((p for p in same if all(not p[k] or not facts[k] or p[k] == facts[k] for k in _SINGLE)), None)
            if mine is None:
                mine = {**dict.fromkeys(facts), "prior_convictions": [], "name": name, "role": m[1], "seq": sum(map(len, known.values()))}
                same.append(mine)
            convictions = list(dict.fromkeys(mine["prior_convictions"] + facts["prior_convictions"]))
            mine.update({k: mine[k] or v for k, v in facts.items()}, prior_convictions=convictions)
    for (name, _), same in known.items():
        seen = re.search(f"{re.escape(name[0])}[{_HAN}]{{1,2}}", full) if len(name) > 1 else None
        for p in same:
            p["aka"] = seen[0] if seen and seen[0] != name else None
    firsts: dict[tuple, dict] = {}
    for p in sorted((p for same in known.values() for p in same), key=lambda p: p["seq"]):
        firsts.setdefault((p["name"], p["role"], p["dob"], p["address"]), p)
    return list(firsts.values())


def parties(docs: DataFrame, id_col: str = "doc_id", intro_col: str = "intro", text_col: str | None = None) -> DataFrame:
    """Rows of PARTIES, each document on its own; a null text has none.  text_col is read for aka alone, the introduction if it is None."""
    own = docs.select(F.col(id_col).cast("string").alias("doc_id"), text(F.col(intro_col)).alias("intro"), text(F.col(text_col or intro_col)).alias("full"))
    names = [c.split()[0] for c in PARTIES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [{"doc_id": d, **p} for d, intro, full in zip(*(c.to_pylist() for c in b.columns)) for p in party_list(intro, full)]
            types = {"seq": pa.int64(), "prior_convictions": pa.list_(pa.string())}
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types.get(n, pa.string())) for n in names], names=names)

    return own.mapInArrow(run, PARTIES)


def procuratorate(intro: Column) -> Column:
    """The prosecuting office, null for none."""
    return F.nullif(strip(F.regexp_extract(text(intro), profiles.PROCURATORATE, 1)), F.lit(""))


def prosecutors(intro: Column) -> Column:
    """Names of the prosecutors that the first list in the text has."""
    listed = F.split(F.regexp_extract(text(intro), profiles.PROSECUTORS, 1), r"(?U)[、，和以及\s]+")
    return F.transform(F.filter(listed, lambda n: n != ""), lambda n: strip(F.replace(n, F.lit("检察员"), F.lit(""))))


def lawyers(intro: Column) -> Column:
    """array of struct(name, firm), each once, in order; firm is null where none is named."""
    untitled = lambda c: strip(F.regexp_replace(c, "律师$", ""))

    def one(said: Column) -> Column:
        parts = F.filter(F.transform(F.split(said, "[，、]"), strip), lambda p: p != "")
        firms = F.filter(F.transform(F.slice(parts, 2, 1_000_000_000), untitled), lambda p: p.rlike(profiles.FIRM))
        return F.struct(F.coalesce(untitled(F.get(parts, F.lit(0))), F.lit("")).alias("name"), F.get(firms, F.lit(0)).alias("firm"))

    found = F.transform(F.regexp_extract_all(text(intro), F.lit(profiles.COUNSEL), F.lit(1)), one)
    return F.array_distinct(F.filter(found, lambda x: x["name"] != ""))


# --- sections inside sections ---

_IN_PYTHON = lambda pattern: re.compile(pattern.replace(r"\x{4e00}", "一").replace(r"\x{9fa5}", "龥"))
_TITLE = _IN_PYTHON(profiles.TITLE)
_OPENS = {s: tuple((n, _IN_PYTHON(p)) for n, p in (*own, *profiles.SECTIONS, *profiles.WEAK_SECTIONS)) for s, own in profiles.SYSTEM_SECTIONS.items()}
_HINTS = tuple((n, _IN_PYTHON(p)) for n, p in profiles.EMBEDDED_SECTIONS)
_COURSE = _IN_PYTHON(profiles.COURSE)
_PARTY_AT = re.compile(rf"(?>(?:{profiles.PARTY_ROLES})(?:[（(][^：:（）()]{{0,30}}[）)])*)(?:\s*[：:]|[：:，,。；;、 　\t]*+(?!{profiles.NO_PARTY}))")


def _opened(line: str, system: str, but: str | None) -> str | None:
    """The section that a line opens, by its own mark or by a hint; `but` is none."""
    if _TITLE.match("".join(line.split())):
        named = "标题"
    else:
        named = next((n for n, p in _OPENS[system] if p.search(line)), None)
    if named:
        return named if named != but else None
    return next((n for n, p in _HINTS if n != but and p.search(line)), None)


def _by_lines(name: str, body: str) -> list[tuple[str, str]]:
    lines = body.splitlines()
    system = next((kind for said, kind in profiles.HEAD_SAYS if re.search(said, body[:1000])), "民事")
    pieces: list[tuple[str, list[str]]] = [(name, [])]
    for i, line in enumerate(lines if len(lines) > 1 else []):
        s = line.strip()
        if s and (new := _opened(s, system, None if i else name)):
            pieces.append((new, []))
        pieces[-1][1].append(line)
    cut = [(n, t) for n, own in pieces if (t := "\n".join(own).strip())]
    return cut or [(name, body)]


def refined(name: str, body: str) -> list[tuple[str, str]]:
    """The sections inside one: parties and course out of the case number's, others out of the parties'.

    Each step shortens the text or leaves it as it is, and a text left as it is ends it.
    """
    body = body.strip()
    if name == profiles.CASE_SECTION and (at := _PARTY_AT.search(body)):
        rest = body[at.start() :].strip()
        course = _COURSE.search(rest)
        end = course.start() if course else len(rest)
        parts = _within(name, body[: at.start()]) + _within(profiles.PARTY_SECTION, rest[:end]) + [(profiles.COURSE_SECTION, rest[end:].strip())]
        return [p for p in parts if p[1]]
    if name == profiles.PARTY_SECTION:
        return _within(name, body)
    return [(name, body)] if body else []


def _within(name: str, body: str) -> list[tuple[str, str]]:
    body = body.strip()
    parts = _by_lines(name, body) if body else []
    return parts if parts == [(name, body)] else [x for p in parts for x in refined(*p)]


REFINED = "doc_id string, seq long, part long, section string, text string"


def refine_sections(sections: DataFrame, id_col: str = "doc_id", order: str = "seq", section_col: str = "section", text_col: str = "text") -> DataFrame:
    """sections() with the sections that stand inside others cut out, ordered by (seq, part).

    Each row is cut on its own, so nothing is shuffled; a row without text gives none.
    """
    own = sections.select(F.col(id_col).cast("string").alias("doc_id"), F.col(order).cast("long").alias("seq"), text(F.col(section_col)).alias("section"), text(F.col(text_col)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(d, q, i, n, t) for d, q, name, body in zip(*(c.to_pylist() for c in b.columns)) for i, (n, t) in enumerate(refined(name, body))]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[c.split()[0] for c in REFINED.split(", ")])

    return own.mapInArrow(run, REFINED)


# --- whole records ---


def named_texts(chunks: DataFrame, groups: dict[str, tuple[str, ...]], key: str = "doc_id", order: str = "chunk_index", section_col: str = "section", text_col: str = "text") -> DataFrame:
    """One row for each document with a text for each group: those of its sections in order, a line each, and `full`, of all."""

    def joined(c: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c, F.struct(order, text(F.col(text_col)).alias("t"))))), lambda x: x["t"]), "\n")

    section = strip(text(F.col(section_col)))
    return chunks.groupBy(key).agg(*[strip(joined(section.isin(*names))).alias(n) for n, names in groups.items()], joined(F.lit(True)).alias("full"))


def criminal_records(chunks: DataFrame, key: str = "doc_id", order: str = "chunk_index") -> DataFrame:
    """(key, procuratorate, prosecutors, lawyers, dispute_focus, opinion_summary) of criminal judgments from their chunks."""
    groups = {"intro": profiles.INTRO_SECTIONS, "defence": profiles.DEFENCE_SECTIONS, "opinion": profiles.OPINION_SECTIONS}
    t = named_texts(chunks, groups, key, order)
    intro, opinion = F.col("intro"), F.col("opinion")
    return t.select(key, procuratorate(intro).alias("procuratorate"), prosecutors(intro).alias("prosecutors"), lawyers(intro).alias("lawyers"), extract.dispute_focus(opinion, F.col("defence")).alias("dispute_focus"), extract.opinion_summary(opinion).alias("opinion_summary"))


def attach(chunks: DataFrame, info: DataFrame, key: str = "doc_id", order: str = "chunk_index", everywhere: bool = False) -> DataFrame:
    """chunks with a struct judgment_info of their document's row of info: in the first chunk, or in all."""
    packed = info.select(key, F.struct(*[c for c in info.columns if c != key]).alias("judgment_info"))
    if everywhere:
        return chunks.join(packed, key, "left")
    first = F.row_number().over(Window.partitionBy(key).orderBy(order)) == 1
    return chunks.withColumn("_first", first).join(packed, key, "left").withColumn("judgment_info", F.when(F.col("_first"), F.col("judgment_info"))).drop("_first")
