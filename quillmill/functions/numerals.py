"""Numerals in Chinese script, article numbers, dates and terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = {**{c: i for i, c in enumerate("零一二三四五六七八九")}, "〇": 0, "两": 2, **{str(i): i for i in range(10)}}
UNITS = {"十": 10, "百": 100, "千": 1000}
NUMERAL = "[0-9〇零两一二三四五六七八九十百千万]"
_WIDE = "０１２３４５６７８９"


def _lookup(table: dict[str, int], c: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in (kv[0], kv[1])]), c)


def narrow_digits(c: Column) -> Column:
    return F.translate(c, _WIDE, "0123456789")


def cn_to_int(c: Column) -> Column:
    """The number that a numeral starts with; 0 for none.

    Units up to ten thousand, digit runs and mixtures; white space is skipped, and reading ends at
    the first other character.  第 and 条 are ignored.  A plain signed integer is itself.
    """
    return let(F.regexp_replace(narrow_digits(F.coalesce(c.cast("string"), F.lit(""))), r"(?U)^\s+|\s+$", ""), _folded)


def _folded(s: Column) -> Column:
    t = F.regexp_replace(s, "[第条]", "")
    kind = "struct<total:bigint,section:bigint,number:bigint,over:boolean>"  # fields may be null: all branches alike
    start = F.struct(F.lit(0), F.lit(0), F.lit(0), F.lit(False)).cast(kind)

    def state(total, section, number, over=None) -> Column:
        return F.struct(total, section, number, F.lit(False) if over is None else over).cast(kind)

    def step(a: Column, x: Column) -> Column:
        digit, unit = _lookup(DIGITS, x), _lookup(UNITS, x)
        number = a["number"]
        myriad = a["section"] + number
        return (
            F.when(a["over"] | (x == "") | x.rlike(r"(?U)^\s$"), a)
            .when(x == "万", state(a["total"] + F.when(myriad == 0, 1).otherwise(myriad) * 10000, F.lit(0), F.lit(0)))
            .when(unit.isNotNull(), state(a["total"], a["section"] + F.greatest(number, F.lit(1)) * unit, F.lit(0)))
            .when(digit.isNotNull(), state(a["total"], a["section"], number * 10 + digit))
            .otherwise(state(a["total"], a["section"], number, F.lit(True)))
        )

    folded = F.aggregate(F.split(t, ""), start, step, lambda a: a["total"] + a["section"] + a["number"])
    return F.when(s.rlike("^-?[0-9]{1,18}$"), s.try_cast("bigint")).otherwise(folded)


def int_to_cn(n: Column) -> Column:
    """The numeral of 0 to 9999, as used for articles."""
    figures = F.array(*[F.lit(c) for c in "零一二三四五六七八九"])
    text = F.lit("")
    for p, unit in ((1000, "千"), (100, "百"), (10, "十"), (1, "")):
        d = F.floor(n / p) % 10
        here = F.concat(F.get(figures, d.cast("int")), F.lit(unit))
        below = n % p
        gap = F.lit("零") if p < 1000 else F.lit("")
        higher = F.floor(n / (p * 10)) > 0
        text = F.concat(text, F.when(d > 0, here).when(higher & (below > 0) & (F.floor(n / (p * 10)) % 10 > 0), gap).otherwise(""))
    text = F.regexp_replace(text, "^一十", "十")
    return F.when(n == 0, "零").otherwise(text)


def span_bounds(span: Column) -> Column:
    """struct(l, r) of an article span `a~b`; both null for an empty one."""
    parts = F.split(span, "~", 2)
    left = cn_to_int(F.get(parts, F.lit(0)))
    right = F.when(F.size(parts) > 1, cn_to_int(F.get(parts, F.lit(1)))).otherwise(left)
    none = F.coalesce(span, F.lit("")) == ""
    return F.struct(F.when(~none, left).alias("l"), F.when(~none, right).alias("r"))


def let(value: Column, body) -> Column:
    """body(value), with value computed once though body uses it often."""
    return F.transform(F.array(value), body)[0]


def _range(pair_l: Column, pair_r: Column) -> Column:
    def filled(p: Column) -> Column:
        a, b = p["a"], p["b"]
        a, b = F.when(a <= 0, b).otherwise(a), F.when(b <= 0, a).otherwise(b)
        return F.named_struct(F.lit("lo"), F.least(a, b), F.lit("hi"), F.greatest(a, b))

    def numbers(p: Column) -> Column:
        return F.when(p["hi"] > 0, F.sequence(F.greatest(p["lo"], F.lit(1)), p["hi"])).otherwise(F.array().cast("array<bigint>"))

    return let(let(F.named_struct(F.lit("a"), cn_to_int(pair_l), F.lit("b"), cn_to_int(pair_r)), filled), numbers)


def expand_articles(c: Column) -> Column:
    """All article numbers that a text names: ranges, lists and single ones, ascending.

    A continuation mark （续n） is dropped first, so that spans which end in one keep their range.
    """
    n = NUMERAL + "+"
    rng = rf"第?\s*({n})\s*条?\s*(?:至第|到第|至|到|-)\s*第?\s*({n})\s*条?"
    one = rf"第\s*({n})\s*条"
    t = F.regexp_replace(narrow_digits(F.coalesce(c.cast("string"), F.lit(""))), "[－—–~]", "-")
    return let(F.regexp_replace(t, "（续[0-9]+）", ""), lambda t: _expanded(t, rng, one))


def _expanded(t: Column, rng: str, one: str) -> Column:
    spans = F.flatten(F.zip_with(F.regexp_extract_all(t, F.lit(rng), F.lit(1)), F.regexp_extract_all(t, F.lit(rng), F.lit(2)), lambda a, b: _range(a, b)))
    rest = F.regexp_replace(t, rng, " ")
    singles = F.transform(F.regexp_extract_all(rest, F.lit(one), F.lit(1)), cn_to_int)
    rest = F.regexp_replace(rest, one, " ")
    loose = F.transform(F.split(rest, r"[、,，；;\s]"), cn_to_int)
    return F.array_sort(F.array_distinct(F.filter(F.concat(spans, singles, loose), lambda x: x > 0)))


def term_months(c: Column) -> Column:
    """Months of a term such as 三年六个月; null for life, death or none."""
    years = cn_to_int(F.regexp_extract(c, rf"({NUMERAL}+)\s*年", 1))
    months = cn_to_int(F.regexp_extract(c, rf"({NUMERAL}+)\s*个?月", 1))
    total = years * 12 + months
    return F.when(c.rlike("无期|死刑") | (total <= 0), None).otherwise(total)


def cn_amount(c: Column) -> Column:
    """An amount with 亿 and 万; null if it is zero."""
    t = F.regexp_replace(narrow_digits(F.coalesce(c, F.lit(""))), r"(?U)[\s,，元]", "")
    hundred_millions = F.when(t.contains("亿"), cn_to_int(F.substring_index(t, "亿", 1))).otherwise(0)
    after = F.when(t.contains("亿"), F.substring_index(t, "亿", -1)).otherwise(t)
    total = hundred_millions * 100_000_000 + cn_to_int(after)
    return F.when(total > 0, total)


def cn_date(c: Column) -> Column:
    """ISO date of a Chinese date, or null if the calendar has none such."""
    t = narrow_digits(F.coalesce(c, F.lit("")))
    d = rf"({NUMERAL}+)\s*年\s*({NUMERAL}+)\s*月\s*({NUMERAL}+)\s*[日号]"
    y, m, day = (cn_to_int(F.regexp_extract(t, d, i)) for i in (1, 2, 3))
    made = F.try_to_date(F.concat_ws("-", y.cast("string"), m.cast("string"), day.cast("string")), "y-M-d")
    return F.when((y >= 1000) & (y <= 9999), F.date_format(made, "yyyy-MM-dd"))
