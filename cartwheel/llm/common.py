"""Helpers shared by the operators: columns by exact name, row keys, stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LETTERS_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_position(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with positional column names, and the new name of each old one.

    Extra columns may clash with each other or differ in case only; a name
    stands for its first exact occurrence."""
    names = [f"c{i}" for i in range(len(df.columns))]
    where: dict[str, str] = {}
    for new, old in zip(names, df.columns, strict=True):
        where.setdefault(old, new)
    return df.toDF(*names), where


def take(df: DataFrame, **kinds: str) -> DataFrame:
    """Just the named columns, cast to the given types; a missing one is null."""
    plain, where = by_position(df)
    return plain.select(*[
        (F.col(where[c]) if c in where else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])


def _keys() -> dict[str, Column]:
    return {"k": F.coalesce("doc_id", F.lit(0)), "h": F.xxhash64("doc_id", "text")}


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with (k, no_id) in place of doc_id: pandas holds whole numbers
    exactly only where none is null."""
    return rows.withColumns({"k": F.coalesce("doc_id", F.lit(0)), "no_id": F.col("doc_id").isNull()}).drop("doc_id")


def renumbered(rows: DataFrame) -> DataFrame:
    """The reverse of ``numbered``."""
    own = F.when(~F.col("no_id"), F.col("k")).alias("doc_id")
    return rows.select(own, *[c for c in rows.columns if c not in ("k", "no_id")])


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text, k, h): rows equal in doc_id and text share the key (k, h), which is
    never null, and are one document; rows that only share a doc_id, or have none, stay apart."""
    return take(docs, doc_id="bigint", text="string").withColumns(_keys())


def keyed_rows(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list[str]]:
    """All columns of ``docs`` under positional names, with doc_id, text, k, h beside them;
    where each named column went, and the positional names."""
    plain, where = by_position(docs)
    both = plain.withColumns({
        "doc_id": F.col(where["doc_id"]).cast("bigint"), "text": F.col(where["text"])}).withColumns(_keys())
    return both, where, plain.columns


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else (``lower`` is the same on pure ASCII, and faster)."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, LETTERS_UPPER, LETTERS_LOWER))


def may_be_first(value: Column, rows: int, of: Column) -> Column:
    """Whether a row can be among the ``rows`` with the smallest xxhash64 of ``value``, of ``of`` rows with distinct
    values: its hash lies under a cut that leaves room for ten standard deviations. What passes is ranked
    afterwards, so that a few times ``rows`` are shuffled, whatever the input."""
    share = (F.lit(float(rows + 10 * rows ** 0.5 + 10))) / of
    return value.cast("double") / F.lit(2.0 ** 64) + 0.5 <= share


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. A local master
    without one gets a folder of its own; a cluster must name one."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile
        named = f"file://{tempfile.mkdtemp(prefix='cartwheel-llm-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """The application's own folder of stored tables under the shared folder."""
    return f"{shared_folder(spark)}/cartwheel-llm-{spark.sparkContext.applicationId}"


def drop_stored(spark: SparkSession) -> None:
    """Removes the application's stored tables. Results of operators are read from them: write those first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the run's folder and read back: cuts the
    lineage, survives lost executors. Eager. It stays until ``drop_stored``."""
    path = f"{run_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
