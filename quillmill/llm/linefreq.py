"""Quality rules: lines that many documents of a host share.

Lines are normalised (lower case, words joined by single spaces) and hashed.  For each host and
line the distinct documents that have the line are counted.  A line above the limit is removed; a
document that loses most of its words so, or keeps too few, is rejected.  All of it is expressions
and joins; a text is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, WORD, bounded, let, materialise, table

#: A line is removed if more distinct documents of its host than LEAST have it, however large the
#: host is.
LEAST = 10
#: A document is depleted if removal leaves fewer words, or a smaller part of its words.
LEAST_WORDS, LEAST_LEFT = 10, 0.3
WINDOW = 5


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def _repeated(words: Column, n: int = WINDOW) -> Column:
    """How many words stand in windows of n words that occur twice or more, the first included.

    Windows are compared by a 64-bit hash of their words.
    """

    def hashes(w: Column) -> Column:
        return F.when(F.size(w) < n, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)]))
        )

    def positions(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda s: F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return let(pairs, lambda s: F.array_sort(F.transform(same(s), lambda x: x["i"])))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, i: F.when(i == 0, n).otherwise(F.least(F.lit(n), x - F.get(p, i - 1)))), F.lit(0), lambda a, x: a + x)

    def counted(h: Column) -> Column:
        twice = lambda s: F.exists(F.transform(s, lambda x, i: x == F.get(s, i - 1)), lambda x: x)
        return F.when(let(F.sort_array(h), twice), let(positions(h), covered)).otherwise(0)

    return let(words, lambda w: let(hashes(w), counted))


def _line(line: Column) -> Column:
    return let(_words(F.lower(line)), lambda w: F.struct(F.xxhash64(w).alias("h"), F.size(w).alias("n")))


def profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """For each row of docs its base counts and the hashes and word counts of its lines.

    Null texts count as empty.  Other columns are not looked at.
    """
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            _repeated(w).cast("long").alias("n_repeat_words"),
        )

    def lines(found: Column) -> Column:
        return F.struct((F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"), F.transform(found, _line).alias("lines"))

    found = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.xxhash64(t).alias("text_hash"),
        let(_words(t), counts).alias("w"),
        (F.size(F.split(t, r"[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
        let(F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)), lines).alias("l"),
    )
    return found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "host", "text_hash", "w.*", "n_symbols", "l.*")


def frequent_lines(profiles: DataFrame, least: int = LEAST, copies_once: bool = False) -> DataFrame:
    """(host, h, found): the lines of each host that more than least documents have.

    A document is a doc_id; each row without one is a document of its own.  With copies_once the
    distinct texts are counted instead.  Distinct (host, line, document) triples are made first, so
    that a line of very many documents is spread over tasks and arrives as counts.
    """
    document = F.col("text_hash") if copies_once else F.when(F.col("doc_id").isNull(), F.xxhash64("row", F.lit(1))).otherwise(F.xxhash64(F.col("doc_id").cast("string")))
    each = profiles.select("host", document.alias("document"), F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    return each.distinct().groupBy("host", "h").agg(F.count("*").alias("found")).where(F.col("found") > least)


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", least: int = LEAST, copies_once: bool = False, least_words: int = LEAST_WORDS, least_left: float = LEAST_LEFT) -> DataFrame:
    """Base counts and verdict for each row of docs.

    n_removed_words counts the words of lines above their host's limit; such a row is rejected if
    fewer than least_words or least_left of its words are left.  base_failed: fewer than ten
    words, or more than a fifth of them in repeated windows.  Null texts have no word and fail;
    a null host is a host of its own; repeated rows are one document and come back each.
    """
    profiles = materialise(profile(docs, id_col, text_col, host_col))
    frequent = bounded(materialise(frequent_lines(profiles, least, copies_once).select(F.col("host").alias("its_host"), F.col("h").alias("its_h"))))
    lines = profiles.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.*")
    gone = lines.join(frequent, (F.col("h") == F.col("its_h")) & F.col("host").eqNullSafe(F.col("its_host"))).groupBy("row").agg(F.sum("n").alias("gone"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < least_words) | (left < F.col("n_words") * least_left))
    return (
        profiles.drop("lines", "text_hash")
        .join(gone, "row", "left")
        .withColumn("n_removed_words", F.coalesce("gone", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
        .drop("gone", "row")
    )


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", least: int = LEAST, copies_once: bool = False) -> DataFrame:
    """docs with the lines above their host's limit cut out of the texts; null texts stay null."""
    own = materialise(docs.withColumn("_row", F.monotonically_increasing_id()))
    frequent = frequent_lines(profile(own, id_col, text_col, host_col), least, copies_once)
    each = own.select("_row", F.col(host_col).cast("string").alias("host"), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("at", "line"))
    each = each.withColumn("h", _line(F.col("line"))["h"])
    f = frequent.select(F.col("host").alias("its_host"), F.col("h").alias("its_h"))
    kept = each.join(f, (F.col("h") == F.col("its_h")) & F.col("host").eqNullSafe(F.col("its_host")), "left_anti")
    text = kept.groupBy("_row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("_text"))
    out = own.join(text, "_row", "left")
    new = F.when(own[text_col].isNull(), None).otherwise(F.coalesce("_text", F.lit("")))
    return out.select(*[new.alias(c) if c == text_col else own[c] for c in docs.columns])


def op3_line_frequency(spark, sf_dir: str) -> DataFrame:
    found = line_quality(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


OP3_SQL = r"""
with d as (
  select doc_id, source, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
), win as (
  select doc_id, i, list_slice(w, i, i + 4) as g from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d)
), twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from win) where c > 1
), rep as (
  select doc_id, count(distinct i + o)::bigint as n from twice, range(5) t(o) group by doc_id
), l as (
  select doc_id, source, line, regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') as lw
  from (select doc_id, source, text, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]')
), dup as (
  select doc_id, (count(*) - count(distinct line))::bigint as n from l group by doc_id
), freq as (
  select source, lw from l group by source, lw having count(distinct doc_id) > 10
), gone as (
  select doc_id, sum(len(lw))::bigint as n from l join freq using (source, lw) group by doc_id
), m as (
  select d.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         coalesce(dup.n, 0) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words, coalesce(gone.n, 0) as n_removed_words
  from d left join dup using (doc_id) left join rep using (doc_id) left join gone using (doc_id)
), v as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (n_removed_words > 0 and (n_words - n_removed_words < 10 or n_words - n_removed_words < n_words * 0.3::double)) as kept,
       n_removed_words
from v
"""
