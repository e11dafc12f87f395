"""Change detection, merges by key, and updates.

Plain Parquet has no merge: merge_upsert() gives the new state as a frame, and
sources.writers.publish() swaps it in as a new version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_by_key(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row a key: the last in order, as sequential writes would leave it."""
    w = Window.partitionBy(*key).orderBy(F.col(order).desc())
    return rows.withColumn("_no", F.row_number().over(w)).where("_no = 1").drop("_no")


def first_by_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key; rows whose key is null or empty are all kept."""
    filled = F.coalesce(F.col(key).cast("string"), F.lit("")) != ""
    w = Window.partitionBy(key).orderBy(*order)
    ranked = rows.where(filled).withColumn("_no", F.row_number().over(w)).where("_no = 1").drop("_no")
    return ranked.unionByName(rows.where(~filled))


def change_status(incoming: DataFrame, existing: DataFrame, key: str = "chunk_id", text: str = "text", sha: str = "text_sha1", skip_existing: bool = False) -> DataFrame:
    """incoming with status NEW, CHANGED or SAME against the rows of existing.

    Hashes are compared; where the old row has none, that of its text is made.
    """
    hashed = F.coalesce(F.col(sha), F.lit("")) != ""  # only hashes of old texts are shuffled
    old = existing.select(F.col(key).alias("_key"), F.when(hashed, F.col(sha)).otherwise(F.sha1(F.col(text).cast("string"))).alias("_sha"), hashed.alias("_hashed"))
    joined = incoming.join(old, F.col(key) == F.col("_key"), "left")
    same = F.when(F.col("_hashed"), F.col("_sha") == F.sha1(F.coalesce(F.col(text), F.lit("")))).otherwise(F.col("_sha").eqNullSafe(F.sha1(F.col(text))))
    status = F.when(F.col("_key").isNull(), "NEW").when(F.lit(skip_existing) | same, "SAME").otherwise("CHANGED")
    return joined.withColumn("status", status).drop("_key", "_sha", "_hashed")


POLICIES = ("set", "set_on_insert", "add_to_set", "max")


def merge_upsert(old: DataFrame, new: DataFrame, key: list[str], policy: dict[str, str]) -> DataFrame:
    """The state after new is merged into old; keys are unique in each.

    set: the new value if the key comes in; set_on_insert: the old value if the key is known;
    add_to_set: the sorted union of arrays; max: the greater value.  Columns without a policy are
    set.  Rows with a null key are left out, as they cannot be addressed.
    """
    rest = [c for c in new.columns if c not in key]
    if bad := set(policy.values()) - set(POLICIES):
        raise ValueError(f"unknown policies: {sorted(bad)}")
    known = lambda f: f.where(F.expr(" and ".join(f"`{k}` is not null" for k in key)))
    o = known(old).select(*key, F.struct(*rest).alias("_o"))
    n = known(new).select(*key, F.struct(*rest).alias("_n"))
    joined = o.join(n, key, "full_outer")

    def merged(c: str) -> Column:
        a, b = F.col(f"_o.{c}"), F.col(f"_n.{c}")
        match policy.get(c, "set"):
            case "set_on_insert":
                return F.when(F.col("_o").isNotNull(), a).otherwise(b)
            case "add_to_set":
                kind = new.schema[c].dataType
                none = F.array().cast(kind)
                return F.array_sort(F.array_union(F.coalesce(a, none), F.coalesce(b, none)))
            case "max":
                return F.greatest(a, b)
        return F.when(F.col("_n").isNotNull(), b).otherwise(a)

    return joined.select(*key, *[merged(c).alias(c) for c in rest])


def replace_by_key(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """old with the rows of all keys in new replaced by those of new."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def delete_by_key(rows: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(keys.select(*key).distinct(), key, "left_anti")


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows that an earlier run has not finished."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def restricted(rows: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    return rows.join(chosen.select(key).distinct(), key, "left_semi")


def with_parent(rows: DataFrame, parents: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """rows with struct parent: the parent's fields, or made from the row itself where there is none."""
    p = parents.select(key, F.struct(*fields).alias("_parent"))
    own = F.struct(*[F.col(f) if f in rows.columns else F.lit(None).cast(parents.schema[f].dataType).alias(f) for f in fields])
    return rows.join(p, key, "left").withColumn("parent", F.coalesce("_parent", own)).drop("_parent")


def conditional_update(rows: DataFrame, column: str, value: str, where: Column) -> DataFrame:
    """rows with column set to value where the condition is true (not null)."""
    return rows.withColumn(column, F.when(F.coalesce(where, F.lit(False)), F.lit(value)).otherwise(F.col(column)))


def older_version(law: str, cutoff: str, name: str = "law_name", date: str = "version_date") -> Column:
    """Rows of a law whose version is older than a day; dates that cannot be read are not."""
    return (F.col(name) == law) & (F.try_to_date(F.col(date), "y-M-d") < F.to_date(F.lit(cutoff)))


def move_type(rows: DataFrame, to: str = "judgment") -> DataFrame:
    """doc_type becomes a constant; what it was goes to doctype_detail."""
    return rows.withColumns({"doctype_detail": F.col("doc_type"), "doc_type": F.lit(to)})


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that a unique index would refuse, with their counts."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
