"""Which items of a contract are present, and checks of extracted graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import profiles
from ..functions.text import text
from .blocks import blocks, bounded, united

def item_rows(spark, items: dict[str, str] = profiles.PRESENCE_ITEMS) -> DataFrame:
    """(contract_type, id, label, required, seq) from lines of id, label and an asterisk for required ones."""
    rows = [(kind, *line.removesuffix(" *").split(" ", 1), line.endswith(" *"), i) for kind, lines in items.items() for i, line in enumerate(lines.strip().split("\n"))]
    return spark.createDataFrame(rows, "contract_type string, id string, label string, required boolean, seq int")


def presence_matrix(docs: DataFrame, clauses: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, contract_type, id, required, present, sources): each item of a document's type against its clauses.

    docs (doc_id, contract_type), clauses (doc_id, order, chunk_id, clause_type array).
    """
    each = clauses.select("doc_id", "order", "chunk_id", F.explode(F.array_distinct("clause_type")).alias("id"))
    by = each.groupBy("doc_id", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("order", "chunk_id"))), lambda s: s["chunk_id"]).alias("sources"))
    wanted = docs.select("doc_id", "contract_type").join(bounded(items), "contract_type")
    return wanted.join(by, ["doc_id", "id"], "left").select("doc_id", "contract_type", "id", "required", F.col("sources").isNotNull().alias("present"), F.coalesce("sources", F.array().cast("array<string>")).alias("sources"))


def matches(body: Column, tags: Column, rule: Column) -> Column:
    """How a text meets a rule struct<tags, all, any, regex>: the first kind that holds, or null."""
    none = F.array().cast("array<string>")
    get = lambda f: F.coalesce(rule[f], none)
    has = lambda k: F.contains(text(body), k)
    return (
        F.when(F.arrays_overlap(F.coalesce(tags, none), get("tags")), "tags")
        .when((F.size(get("all")) > 0) & F.forall(get("all"), has), "all")
        .when(F.exists(get("any"), has), "any")
        .when(F.exists(get("regex"), lambda r: F.regexp(text(body), r)), "regex")
    )


def rule_presence(clauses: DataFrame, rules: DataFrame) -> DataFrame:
    """(doc_id, id, present, sources): which clauses meet each rule; rules (id, rule) go out in blocks of bounded size."""
    how = matches(F.col("text"), F.col("clause_type"), F.col("rule"))
    hit = united([clauses.crossJoin(F.broadcast(b)) for b in blocks(rules, "id")]).withColumn("how", how)
    got = F.array_sort(F.collect_list(F.when(F.col("how").isNotNull(), F.struct("order", "clause_id"))))
    return hit.groupBy("doc_id", "id").agg(F.transform(got, lambda s: s["clause_id"]).alias("sources")).withColumn("present", F.size("sources") > 0)


def errors(*checks: tuple[str, Column, str]) -> Column:
    """array<struct<loc, msg>> of the checks that fail: where, what must hold, what is said if not."""
    kind = "array<struct<loc:string,msg:string>>"
    each = [F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(loc).alias("loc"), F.lit(msg).alias("msg"))) for loc, ok, msg in checks]
    return F.filter(F.array(*each), lambda x: x.isNotNull()).cast(kind)


def required(column: str) -> tuple[str, Column, str]:
    return column, text(F.col(column)) != "", "field required"


def one_of(column: str, values: list[str]) -> tuple[str, Column, str]:
    return column, F.col(column).isNull() | F.col(column).isin(*values), "not a permitted value"


def between(column: str, low: float, high: float) -> tuple[str, Column, str]:
    return column, F.col(column).isNull() | F.col(column).between(low, high), f"not in {low}..{high}"


def known_ids(column: str, ids: str) -> tuple[str, Column, str]:
    return column, F.size(F.array_except(F.coalesce(F.col(column), F.array().cast("array<string>")), F.coalesce(F.col(ids), F.array().cast("array<string>")))) == 0, "unknown id"


def mentioned_but_empty(body: Column, wanted: dict[str, tuple[str, Column]]) -> Column:
    """Names of lists that are empty though the text speaks of what they hold."""
    found = [F.when(text(body).rlike(pattern) & (F.coalesce(F.size(c), F.lit(0)) <= 0), F.lit(name)) for name, (pattern, c) in wanted.items()]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def procedure_stage(level: Column) -> Column:
    """The stage that a level of trial names; first instance if it names none."""
    said = F.trim(text(level))
    stage = F.when(F.contains(said, F.lit("再审")) | (said == "retrial"), "retrial").otherwise("first_instance")
    for name, levels in reversed(profiles.PROCEDURE_STAGES):
        stage = F.when(said.isin(*levels), name).otherwise(stage)
    return stage


def party_type(c: Column) -> Column:
    t = F.lower(F.trim(text(c)))
    t = F.when(t == "organization", "company").otherwise(t)
    return F.when(t.isin(*profiles.PARTY_TYPES), t).otherwise("other")


def filled(new: Column, old: Column, default: Column) -> Column:
    """The new string if it is not blank, else the old one, else a default."""
    return F.coalesce(F.nullif(F.trim(new), F.lit("")), F.nullif(F.trim(old), F.lit("")), default)


def deep_merge(schema, new: Column, old: Column, default: Column) -> Column:
    """A struct of the template's shape: new over old over default, field by field; absent is null."""
    out = []
    for f in schema.fields:
        n, o, d = (c.getField(f.name) for c in (new, old, default))
        if f.dataType.typeName() == "struct":
            v = deep_merge(f.dataType, n, o, d)
        elif f.dataType.typeName() == "string":
            v = filled(n, o, d)
        elif f.dataType.typeName() == "array":
            v = F.coalesce(F.when(F.size(n) > 0, n), F.when(F.size(o) > 0, o), d)
        else:
            v = F.coalesce(n, o, d)
        out.append(v.alias(f.name))
    return F.struct(*out)


def backfill_clauses(graph: DataFrame, seeds: DataFrame) -> DataFrame:
    """(doc_id, clauses): clauses whose text is blank get that of their seed; a document without clauses gets all seeds, in order."""
    g = graph.select("doc_id", F.posexplode_outer("clauses").alias("i", "c")).select("doc_id", "i", "c.clause_id", "c.text")
    s = seeds.select("doc_id", "clause_id", F.col("text").alias("seed"), F.row_number().over(Window.partitionBy("doc_id").orderBy("clause_id")).alias("no"))
    given = g.where("clause_id is not null").join(s, ["doc_id", "clause_id"], "left").select("doc_id", "i", "clause_id", F.coalesce(F.nullif(F.trim("text"), F.lit("")), "seed", F.lit("")).alias("text"))
    bare = g.where("i is null").select("doc_id").join(s, "doc_id").select("doc_id", F.col("no").alias("i"), "clause_id", F.col("seed").alias("text"))
    got = F.array_sort(F.collect_list(F.struct("i", "clause_id", "text")))
    return given.unionByName(bare).groupBy("doc_id").agg(F.transform(got, lambda x: F.struct(x["clause_id"], x["text"])).alias("clauses"))
