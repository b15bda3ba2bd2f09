"""Result sinks.

``single_file=True`` asks for one output file (the reference's chart CSVs are
read back by a single pandas process). It is done with ``repartition(1)``
rather than ``coalesce(1)``: coalesce would pull the single-partition limit
up into the query and run all of it in one task; repartition keeps the query
parallel and only the final write is one task. Meant for small results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    out = df.repartition(1) if single_file else df
    out.write.mode(mode).option("header", "true").csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read back a CSV result with a known schema (no inference pass)."""
    return spark.read.option("header", "true").schema(schema).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
