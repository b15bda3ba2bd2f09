"""Tables laid out by two columns at once, and how much of a table a lookup has to read.

``write`` sorts a table by the interleaved bits of an id and of a time or date (``functions.zorder``)
and cuts it into row groups of ``rows_in_group`` rows; lookups by either column then read
few of them, through the ordinary pushed filters. Numeric ids keep their order, so that the
row groups' minima and maxima rule out the others; other ids are spread by their hash and get a
bloom filter in each row group. ``groups_read`` counts, from the files'
own statistics, the row groups that a range of a column admits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cartwheel.functions import zorder

ROWS_IN_GROUP = 100_000


def write(df: DataFrame, path: str, by_id: str, by_time: str, files: int | None = None,
          rows_in_group: int = ROWS_IN_GROUP, mode: str = "overwrite") -> None:
    """``df`` as Parquet in interleaved order of ``by_id`` (compared by equality) and ``by_time`` (by range).

    The order is a range partitioning, so neighbours are in one file and a frequent id is cut by time over
    as many files as it needs. Parquet keeps a range for dates and for times without a zone (``timestamp_ntz``);
    Spark writes other times in a form that has none, and they are found by their files' order only. ``files``: how many (default: the shuffle partitions)."""
    spark = df.sparkSession
    time = F.unix_date(by_time) if dict(df.dtypes)[by_time] == "date" else F.unix_micros(F.col(by_time).cast("timestamp"))
    numeric = isinstance(df.schema[by_id].dataType, NumericType)
    number = F.col(by_id).cast("double") if numeric else F.lit(0.0)
    low, high, first, last = df.agg(F.min(time), F.max(time), F.min(number), F.max(number)).first()
    own = zorder.scaled(number, first or 0, last or 0) if numeric else zorder.spread(F.col(by_id))
    place = zorder.interleaved(own, zorder.scaled(time, low or 0, high or 0))
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = df.withColumn("_z", place).repartitionByRange(n, "_z", by_time).sortWithinPartitions("_z", by_time).drop("_z")
    writer = out.write.mode(mode).option("parquet.block.row.count.limit", rows_in_group)
    if not numeric:
        writer = writer.option(f"parquet.bloom.filter.enabled#{by_id}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)


def groups_read(spark: SparkSession, path: str, column: str, low, high) -> tuple[int, int]:
    """(row groups whose range of ``column`` meets [low, high], all row groups), from the footers on Spark."""
    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file")).distinct()

    def count(batches):
        import pandas as pd
        import pyarrow.fs as pfs
        import pyarrow.parquet as pq
        for b in batches:
            met = every = 0
            for uri in b["file"]:
                fs, name = pfs.FileSystem.from_uri(uri)
                meta = pq.read_metadata(name, filesystem=fs)
                at = meta.schema.names.index(column)
                for g in range(meta.num_row_groups):
                    s = meta.row_group(g).column(at).statistics
                    every += 1
                    met += s is None or not s.has_min_max or not (s.max < low or s.min > high)
            yield pd.DataFrame({"met": [met], "every": [every]})

    r = files.mapInPandas(count, "met bigint, every bigint").agg(F.sum("met"), F.sum("every")).first()
    return int(r[0] or 0), int(r[1] or 0)
