"""Loads that keep broken records apart instead of ending the job or nulling them.

Every record, an element of an array file or a line, is parsed once with the explicit schema.
Those that fit are written as one Parquet table, those that do not as another, with their
file, their place in it, what is wrong and their text: both by the same job, which also
counts them (``observe``), so a load with its report reads the files once. A broken record
hides nothing else: its neighbours are read as if it were not there.

What is wrong with a record: ``no object`` (a number, a string, an empty element ...),
``not JSON`` (cut off, unbalanced, a missing quote), or ``does not fit: a, b`` with the
top-level fields whose values the schema does not take.

An array file that is broken as a whole (cut off, brackets that do not close) is still an
error: where its elements begin and end cannot be told. Blank lines are no records. A
record of nulls only, ``{}``, fits any schema; the cleaning rules decide on it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel import schemas
from cartwheel.operators import clean
from cartwheel.sources import json_arrays, json_source

#: rules that cleaning applies after the load, by dataset
VALID = {"transactions": clean.valid_transaction, "sessions": clean.valid_session, "products": clean.valid_product}
REJECTS = "file string, element bigint, reason string, record string"
#: the text that the parser could not take, null for a record that fits
CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Load:
    """A finished load: ``documents`` that fit the schema, ``rejects`` (file, element, reason, record), and
    how many records were read, rejected, and removed by the cleaning rules (``kept`` is the rest)."""
    documents: DataFrame
    rejects: DataFrame
    read: int
    rejected: int
    removed: int

    @property
    def kept(self) -> int:
        return self.read - self.rejected - self.removed


def line_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, element, text) of the non-blank lines of some files; lines have no number."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.lit(None).cast("bigint").alias("element"),
        F.btrim("value", F.lit(json_arrays.BLANK)).alias("text")).filter("text <> ''")


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, element, text) of all records in files of either layout."""
    arrays = [p for p in paths if json_arrays.holds_array(spark, p)]
    lines = sorted(set(paths) - set(arrays))
    parts = [json_arrays.array_elements(spark, arrays)] if arrays else []
    parts += [line_records(spark, lines)] if lines else []
    if not parts:
        return spark.createDataFrame([], "file string, element bigint, text string")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _misfits(schema: T.StructType) -> Column:
    """The names of the fields that the record gives a value, but the parser gave none."""
    def lost(name: str) -> Column:
        value = F.try_variant_get("given", "$['" + name.replace("'", "\\'") + "']", "variant")
        return F.col("doc").getField(name).isNull() & value.isNotNull() & ~F.is_variant_null(value)

    names = [F.when(lost(f.name), F.lit(f.name)) for f in schema.fields]
    return F.array_join(F.array_compact(F.array(*names)), ", ")


def checked(recs: DataFrame, schema: T.StructType) -> DataFrame:
    """``recs`` (file, element, text) with ``doc`` (the parsed record) and ``reason`` (null where it fits)."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = recs.withColumn("doc", F.from_json("text", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    # a broken record is parsed once more, as a column of its own that all its fields are looked up in
    broken = F.startswith("text", F.lit("{")) & F.col(f"doc.{CORRUPT}").isNotNull()
    parsed = parsed.withColumn("given", F.when(broken, F.try_parse_json("text")))
    return parsed.withColumn("reason", F.when(~F.startswith("text", F.lit("{")), F.lit("no object"))
                             .when(F.col(f"doc.{CORRUPT}").isNull(), F.lit(None).cast("string"))
                             .when(F.col("given").isNull(), F.lit("not JSON"))
                             .otherwise(F.concat(F.lit("does not fit: "), _misfits(schema)))).drop("given")


def load(recs: DataFrame, schema: T.StructType, path: str, valid: Column | None = None) -> Load:
    """Writes the records under ``path`` (one folder each for documents and rejects) and counts them.
    ``valid`` is the cleaning rule over the document's columns; what it removes is counted, not dropped."""
    spark = recs.sparkSession
    rows = checked(recs, schema)
    fits = F.col("reason").isNull()
    plain = rows.select(*[F.col("doc").getField(f.name).alias(f.name) for f in schema.fields],
                        (~fits).alias("_rejected"), F.struct("file", "element", "reason", F.col("text").alias("record")).alias("_source"))
    plain = plain.withColumn("_source", F.when(F.col("_rejected"), F.col("_source")))
    seen = Observation()
    bad = F.lit(False) if valid is None else ~F.coalesce(valid, F.lit(False))
    counted = plain.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if("_rejected").alias("rejected"),
                            F.count_if(~F.col("_rejected") & bad).alias("removed"))
    counted.write.mode("overwrite").partitionBy("_rejected").parquet(path)
    stored = spark.read.schema(counted.schema).parquet(path)
    n = seen.get
    return Load(stored.filter(~F.col("_rejected")).select(*schema.fieldNames()),
                stored.filter("_rejected").select("_source.file", "_source.element", "_source.reason", "_source.record"),
                n["read"], n["rejected"], n["removed"])


def load_dataset(spark: SparkSession, json_dir: str, name: str, path: str) -> Load:
    """One dataset of the shop's JSON folder, loaded into ``path``. A missing dataset is an empty one."""
    recs = records(spark, json_source.existing_paths(spark, json_dir, json_source.FILE_PATTERNS[name]))
    return load(recs, schemas.BY_NAME[name], path, VALID[name]() if name in VALID else None)


def report(spark: SparkSession, loads: dict[str, Load]) -> DataFrame:
    """One row for each dataset: records read, rejected by the load, removed by cleaning, kept."""
    return spark.createDataFrame([(k, x.read, x.rejected, x.removed, x.kept) for k, x in loads.items()],
                                 "dataset string, read bigint, rejected bigint, removed bigint, kept bigint")
