"""Land the shop datasets as Parquet, laid out for the queries that read them.

Two layouts:

* default: plain Parquet folders written through a ``rebalance`` hint on
  ``user_id`` and sorted by (user, time) inside each file. Rows of a user are
  one contiguous sorted run, so a per-user lookup skips row groups on min/max
  statistics. The rebalance is hash partitioning that AQE may split: a user
  holding a third of all rows is written by several tasks instead of one, and
  no sampling pass over the input is needed (a range partitioning would run
  one).
* ``bucketed=True`` (opt-in): users, transactions and sessions become tables
  bucketed by ``user_id`` into the same number of buckets. Spark then knows the
  files' partitioning: per-user aggregations and their joins run with no
  shuffle at all. The price: a bucket is read by one task, so one very hot user
  makes one very long task. Use it when per-user volume is known to be bounded.

Landing is also where lineage is cut: queries start from files, not from the
adapter's joins.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

USER_KEYED = {"users": ["user_id"], "transactions": ["user_id", "timestamp"],
              "sessions": ["user_id", "start_time"]}
# cap file size on large landings (rows); small datasets are unaffected
MAX_RECORDS_PER_FILE = 5_000_000
DERIVED = ("prices", "puts", "timeline", "metrics", "user_numbers", "user_bitmaps")


def _buckets(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table_prefix(path: str) -> str:
    tail = re.sub(r"[^A-Za-z0-9]", "_", path.rstrip("/").split("/")[-1])[-20:]
    return f"cw_{tail}_{uuid.uuid4().hex[:6]}"


def write_all(shop, path: str, mode: str = "overwrite", bucketed: bool = False,
              buckets: int | None = None) -> dict[str, str]:
    """Write the five datasets under ``path``; returns {dataset: table name}
    for bucketed tables (empty when ``bucketed=False``)."""
    spark = shop.users.sparkSession
    base = path.rstrip("/")
    n = buckets or _buckets(spark)
    tables: dict[str, str] = {}
    prefix = table_prefix(base)
    for name in ("products", "categories", "prices", "puts"):
        if getattr(shop, name) is not None:
            getattr(shop, name).write.mode(mode).parquet(f"{base}/{name}")
    for name, sort_cols in USER_KEYED.items():
        df = getattr(shop, name)
        if bucketed:
            # hash-partitioning by the bucket column first makes every write
            # task hold exactly one bucket: one file per bucket, not tasks x
            # buckets; the bucketed writer sorts each bucket by sort_cols
            table = f"{prefix}_{name}"
            (df.repartition(n, "user_id").write.mode(mode)
               .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
               .bucketBy(n, "user_id").sortBy(*sort_cols).format("parquet")
               .option("path", f"{base}/{name}").saveAsTable(table))
            tables[name] = table
        else:
            (df.hint("rebalance", "user_id").sortWithinPartitions(*sort_cols).write.mode(mode)
               .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(f"{base}/{name}"))
    return tables


def write_derived(shop, path: str, mode: str = "overwrite") -> None:
    """The flat session timeline by key, and the daily product metrics with the bitmaps of their
    users by month (a folder for each day would be thousands of small files), sorted by date inside."""
    from cartwheel.operators import distinct_users, metrics, timeline
    base = path.rstrip("/")
    timeline.write_timeline(timeline.user_sessions_flat(shop.sessions), f"{base}/timeline", mode)
    daily = metrics.product_daily_metrics(shop.sessions, shop.transactions)
    _by_month(metrics.with_inventory(daily, shop.products), f"{base}/metrics", mode)
    # the numbers are fixed once they are written
    distinct_users.user_numbers(shop.sessions).write.mode(mode).parquet(f"{base}/user_numbers")
    numbers = shop.sessions.sparkSession.read.parquet(f"{base}/user_numbers")
    _by_month(distinct_users.daily_user_bitmaps(shop.sessions, numbers), f"{base}/user_bitmaps", mode)


def _by_month(daily: DataFrame, path: str, mode: str) -> None:
    month = F.year("date") * 100 + F.month("date")
    # a month's rows together (split if one is huge), so a month is few files
    daily.withColumn("month", month).hint("rebalance", "month").sortWithinPartitions("month", "date", "product_id").write.mode(
        mode).partitionBy("month").parquet(path)


def read_if_there(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.parquet(folder.toString()) if there else None


def read(spark: SparkSession, path: str, name: str, tables: dict[str, str] | None = None) -> DataFrame:
    if tables and name in tables:
        return spark.table(tables[name])
    return spark.read.parquet(f"{path.rstrip('/')}/{name}")
