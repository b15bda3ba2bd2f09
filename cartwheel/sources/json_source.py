"""Readers and writers of the shop's JSON documents.

The generator writes each dataset as ONE JSON array on ONE line (``users.json``,
``products.json`` ..., sessions chunked as ``sessions_*.json``). Such files are read by
many tasks and written again as they were (``json_arrays``); files of JSON lines are read
by Spark's own reader, which splits them. A dataset may mix both, in one file or many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel import schemas
from cartwheel.sources import json_arrays

# one file, or chunks of it
FILE_PATTERNS = {
    "users": "{users,users_*}.json",
    "products": "{products,products_*}.json",
    "categories": "{categories,categories_*}.json",
    "transactions": "{transactions,transactions_*}.json",
    "sessions": "{sessions,sessions_*}.json",
}


def existing_paths(spark: SparkSession, json_dir: str, pattern: str) -> list[str]:
    """Sorted matching files, on any file system Spark can read; a missing
    dataset is skipped (empty list), not an error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{json_dir.rstrip('/')}/{pattern}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found) if found else []


def read_json(spark: SparkSession, paths: list[str] | str, schema, partitions: int | None = None,
              multiline: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """``multiline=True`` (for files holding one JSON array) parses each file
    as a stream of array elements instead of reading it as one giant line;
    use ``multiline=False`` for JSON-lines files, which split across tasks.
    A broken file or a value that does not fit the schema is an error;
    ``mode="PERMISSIVE"`` reads what it can and nulls the rest."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("mode", mode)
    if multiline:
        reader = reader.option("multiLine", "true")
    df = reader.json(paths)
    if partitions:
        df = df.repartition(partitions)
    return df


def read_dataset(spark: SparkSession, json_dir: str, name: str,
                 partitions: int | None = None, mode: str = "FAILFAST") -> DataFrame:
    """One dataset with its explicit schema, from files of either layout: those that begin
    with ``[`` hold an array, the others a document on each line."""
    paths = existing_paths(spark, json_dir, FILE_PATTERNS[name])
    schema = schemas.BY_NAME[name]
    arrays = [p for p in paths if json_arrays.holds_array(spark, p)]
    lines = sorted(set(paths) - set(arrays))
    df = json_arrays.read_arrays(spark, arrays, schema, mode)
    if lines:
        of_lines = read_json(spark, lines, schema, multiline=False, mode=mode)
        df = df.unionByName(of_lines) if arrays else of_lines
    return df.repartition(partitions) if partitions else df


def write_dataset(df: DataFrame, json_dir: str, name: str, per_file: int = json_arrays.PER_FILE,
                  layout: str = "arrays") -> list[str]:
    """Export a dataset as ``<name>_<k>.json`` that ``read_dataset`` reads back, at most ``per_file``
    documents in each file: ``layout`` ``arrays`` as the generator writes them, or ``lines``."""
    return json_arrays.write_arrays(df, json_dir, name, per_file, layout)


def write_json(df: DataFrame, path: str, max_records_per_file: int = 100_000,
               mode: str = "overwrite") -> None:
    """A folder of JSON lines, at most ``max_records_per_file`` documents per file (Spark's own layout;
    ``write_dataset`` writes files that ``read_dataset`` finds)."""
    (df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
       .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))
