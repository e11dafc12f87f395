"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as every contract of this subpackage has it: no space and no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the one that the cluster names in spark.checkpoint.dir.  Where that is unset, a local
    session gets a temporary folder and a cluster one below the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        made = f"file://{tempfile.mkdtemp(prefix='quillmill-')}"
    else:
        made = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_quillmill"
    spark.conf.set("spark.checkpoint.dir", made) if _settable(spark) else None
    return made


def _settable(spark: SparkSession) -> bool:
    try:
        spark.conf.set("spark.quillmill.probe", "1")
        return spark.conf.isModifiable("spark.checkpoint.dir")
    except Exception as e:  # a session that forbids changes
        if "CANNOT_MODIFY" in str(e):
            return False
        raise


def materialise(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again.

    This cuts the lineage in a way that outlives executors, and later reads see only the
    columns that they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillmill-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Delete what materialise() has written for this session; its frames are void then."""
    jvm = spark.sparkContext._jvm
    for own, path in [x for x in _made if x[0] is spark]:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _made.remove((own, path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def n_words(text: Column) -> Column:
    """How many words a text has, counted in one scan of it."""
    parts = F.size(F.split(F.coalesce(text, F.lit("")), BLANK, -1))
    t = F.coalesce(text, F.lit(""))
    first = F.when(F.substring(t, 1, 1).rlike(BLANK), 1).otherwise(0)
    last = F.when(F.substring(t, -1, 1).rlike(BLANK), 1).otherwise(0)
    return F.when(~t.rlike(WORD), F.lit(0)).otherwise(parts - first - last).cast("long")


def let(value: Column, body) -> Column:
    """body(value), with value computed once for each row though body uses it often."""
    return F.transform(F.array(value), body)[0]


def bounded(t: DataFrame, rows: int = 20_000) -> DataFrame:
    """t for a join: broadcast if counting shows that it has few rows (of some 100 bytes)."""
    return F.broadcast(t) if t.count() <= rows else t
