"""Normalisation of texts and names, and identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .profiles import FULL_WIDTH

_EDGES = r"(?U)^\s+|\s+$"


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, _EDGES, "")


def squeeze(c: Column) -> Column:
    """Each run of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(text(c), r"(?U)\s+", " "))


def first_filled(*cols: Column | str) -> Column:
    """The first value that is neither null nor empty, or the empty string."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols], F.lit(""))


def clamp(c: Column, most: int) -> Column:
    """At most so many characters; null is empty."""
    return F.substring(text(c), 1, most)


def normalize_statute(c: Column, dashes: str = "-－") -> Column:
    """Blanks made alike, blank lines thinned, appendix titles joined, page-number lines cleared."""
    t = F.translate(text(c), "　 \t", "   ")
    t = F.regexp_replace(t, "[ \r\f]+", " ")
    t = F.regexp_replace(t, "\n{3,}", "\n\n")
    t = F.regexp_replace(t, r"附\s*则", "附则")
    t = F.regexp_replace(t, r"附\s*件\s*([一二三四五六七八九十]+)", "附件$1")
    t = F.regexp_replace(t, rf"(?m)^\s*[{dashes}]\s*[0-9]+\s*[{dashes}]\s*$", "")
    return strip(t)


def normalize_judgment(c: Column) -> Column:
    return normalize_statute(c, "-－—–")


def clean_contract(c: Column) -> Column:
    """Line ends made alike, full-width punctuation and figures folded, blanks and blank lines thinned."""
    t = F.regexp_replace(text(c), "\r\n?", "\n")
    t = F.translate(t, "".join(FULL_WIDTH) + "\u3000", "".join(FULL_WIDTH.values()) + " ")
    t = F.regexp_replace(t, "[\t\f\x0b]+", " ")
    t = F.regexp_replace(t, " {2,}", " ")
    t = F.regexp_replace(t, "\n{3,}", "\n\n")
    return strip(F.regexp_replace(t, " *\n *", "\n"))


def clean_page(c: Column) -> Column:
    """Text of a page: no-break blanks made plain, words joined that a soft hyphen parts."""
    t = F.regexp_replace(F.translate(text(c), " ", " "), "­\\s*\n?", "")
    return strip(F.regexp_replace(t, "[ \t]+", " "))


def tidy_articles(c: Column) -> Column:
    """`第 3 条 之 1` without its blanks."""
    t = F.regexp_replace(text(c), r"第\s*([0-9〇零一-龥]+?)\s*条", "第$1条")
    return F.regexp_replace(t, r"条\s*之\s*", "条之")


def law_name(c: Column, deep: bool = True) -> Column:
    """A law's name for comparison: no title marks, country prefix or white space.

    deep also drops brackets, middle dots and remarks on amendments.
    """
    t = F.regexp_replace(strip(text(c)), "[《》]", "")
    t = F.regexp_replace(t, r"^\s*中华人民共和国", "")
    if deep:
        t = F.regexp_replace(t, r"（[^）]*修正[^）]*）|\([^)]*修正[^)]*\)", "")
        t = F.regexp_replace(t, r"[()（）\[\]【】＜＞<>〈〉·]", "")
    return F.regexp_replace(t, r"(?U)\s+", "")


def law_title(c: Column) -> Column:
    """law_name() of a title whose inner quotes are opened first."""
    return law_name(F.regexp_replace(text(c), r"[〈⟨<]\s*([^〉》⟩>]+?)\s*[〉》⟩>]", "$1"))


def bare_name(c: Column) -> Column:
    """A raw name without marks at its ends, middle dots and white space."""
    t = F.btrim(strip(text(c)), F.lit("《》〈〉⟪⟨⟫⟩\"“”"))
    return F.regexp_replace(t, r"(?U)[\s·]+", "")


def repair_citations(c: Column) -> Column:
    """Citations whose title or article was broken by line ends or blanks, joined."""
    t = F.regexp_replace(text(c), r"(《[^》\n]{0,60})\n\s*([^》\n]{0,60}》)", "$1$2")
    return F.regexp_replace(t, rf"第\s+([〇零一-龥0-9]+?)\s*([条款项])|第([〇零一-龥0-9]+?)\s+([条款项])", "第$1$3$2$4")


def level_label(c: Column, unit: str) -> Column:
    """A heading label that starts with a Chinese numeral, in full; others as they are."""
    pattern = r"(?s)^([一二三四五六七八九十百千两]+)\s*(.*)$"
    full = F.concat(F.lit("第"), F.regexp_extract(c, pattern, 1), F.lit(f"{unit} "), F.regexp_replace(F.regexp_extract(c, pattern, 2), r"(?U)\s+", ""))
    return F.when(c.rlike(pattern), full).otherwise(c)


def tagged(*parts: tuple[str, Column]) -> Column:
    """Filled parts, each after its tag, a line each."""
    return F.concat_ws("\n", *[F.when(strip(text(c)) != "", F.concat(F.lit(tag), strip(text(c)))) for tag, c in parts])


def estimated_tokens(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text(c)) / 2)).cast("long")


def file_name(c: Column) -> Column:
    """A name without characters that file systems reserve."""
    return strip(F.regexp_replace(text(c), r'[\\/:*?"<>|\r\n\t]+', "_"))


def unfenced(c: Column) -> Column:
    """What stands inside a code fence, if the text is one."""
    return strip(F.regexp_replace(strip(text(c)), r"(?s)^```[A-Za-z]*\s*\n?(.*?)\n?```$", "$1"))


def undouble(c: Column, share: float = 0.4) -> Column:
    """Every other character, if at least that share of characters repeat the one before."""
    chars = F.filter(F.split(text(c), ""), lambda x: x != "")
    same = F.size(F.filter(F.transform(chars, lambda x, i: x == F.get(chars, i - 1)), lambda x: x))
    even = F.array_join(F.filter(chars, lambda x, i: i % 2 == 0), "")
    return F.when((F.size(chars) > 1) & (same >= share * F.size(chars)), even).otherwise(text(c))


def collapse_runs(c: Column) -> Column:
    return F.regexp_replace(text(c), r"([一-鿿])\1+", "$1")


def keyword_score(title: Column, body: Column, keywords: list[str], most: int = 2) -> Column:
    """For each keyword two points if the title has it, and one for each time in body, up to most."""
    t, b = F.lower(text(title)), F.lower(text(body))
    points = [F.when(t.contains(k.lower()), 2).otherwise(0) + F.least(F.size(F.split(b, _quoted(k.lower()), -1)) - 1, F.lit(most)) for k in keywords]
    total = points[0]
    for p in points[1:]:
        total = total + p
    return total


def _quoted(word: str) -> str:
    return "\\Q" + word + "\\E"


# --- identities ---


def chunk_id(doc: Column, span: Column, index: Column) -> Column:
    base = F.concat_ws("#", doc, span, F.lpad(index.cast("string"), F.greatest(F.lit(3), F.length(index.cast("string"))), F.lit("0")))
    return F.concat(base, F.lit("-"), F.substring(F.sha1(base), 1, 8))


def document_id(prefix: str, *parts: Column, length: int = 12) -> Column:
    """An id from what identifies a document, by content rather than by time of change."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha1(F.concat_ws("|", *parts)), 1, length))


def fingerprint(*parts: Column) -> Column:
    return F.concat(F.lit("md5:"), F.md5(F.concat_ws("|", *parts)))


def safe_int(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))
