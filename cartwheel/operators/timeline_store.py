"""The timeline as a stored table that takes batches of puts.

Rows lie in ``slots`` folders by a hash of the user, sorted by row key inside each file, with
bloom filters on the keys looked up. A batch is reduced to the last put of each key; only
the folders its users fall in are read, merged and written again (dynamic partition
overwrite), the others keep their files. Of several puts of a key, in a batch or in different
ones, the one with the largest sequence number stays, so batches may come in any order
and may be repeated. Of puts equal in key and sequence, the one whose JSON text is largest stays.

A user's folder follows from the user id, so a lookup opens one folder; a batch of keys
opens the folders of its users, and there the row groups whose range and bloom filter
admit a key. A hot user's folder is several sorted files, written by several tasks.

One writer at a time; a batch that fails in its tasks leaves the table as it was.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 64
#: columns that lookups test for equality
LOOKED_UP = ("row_key", "session_info_session_id")


def user_of_key(key: Column) -> Column:
    """The user id, as text, of a row key ``<user_id>_<reverse time>``."""
    return F.regexp_extract(key, r"(?s)^(.*)_[^_]*$", 1)


def slot_of(user: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(user.cast("string")), F.lit(slots)).cast("int")


def last_puts(puts: DataFrame, seq: str) -> DataFrame:
    """The last put of each row key. A rank limit of one is applied in each task before the shuffle."""
    tie = F.to_json(F.struct(*puts.columns)).desc()
    newest = Window.partitionBy("row_key").orderBy(F.col(seq).desc(), tie)
    return puts.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


@dataclass(frozen=True)
class TimelineStore:
    spark: SparkSession
    path: str
    slots: int
    seq: str

    @staticmethod
    def create(puts: DataFrame, path: str, slots: int = SLOTS, seq: str = "put_seq") -> TimelineStore:
        """A new table of ``puts`` (row_key, user_id, ``seq`` and any other columns)."""
        spark = puts.sparkSession
        store = TimelineStore(spark, path.rstrip("/"), slots, seq)
        spark.createDataFrame([(slots, seq)], "slots int, seq string").coalesce(1).write.json(f"{store.path}/layout")
        store._write(last_puts(puts, seq), "errorifexists")
        return store

    @staticmethod
    def open(spark: SparkSession, path: str) -> TimelineStore:
        path = path.rstrip("/")
        layout = spark.read.schema("slots int, seq string").json(f"{path}/layout").first()
        return TimelineStore(spark, path, layout.slots, layout.seq)

    @property
    def rows_path(self) -> str:
        return f"{self.path}/rows"

    def _write(self, rows: DataFrame, mode: str) -> None:
        out = rows.withColumn("slot", slot_of(F.col("user_id"), self.slots)).hint("rebalance", "slot")
        writer = out.sortWithinPartitions("slot", "user_id", "row_key").write.mode(mode).partitionBy("slot")
        for c in LOOKED_UP:
            if c in rows.columns:
                writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        # filters as large as the keys of a row group need, not a megabyte each
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.rows_path)

    def stored(self) -> DataFrame:
        """All rows, with their slot."""
        return self.spark.read.parquet(self.rows_path)

    def read(self) -> DataFrame:
        return self.stored().drop("slot")

    def upsert(self, batch: DataFrame) -> list[int]:
        """Merge a batch of puts; returns the slots that were written again."""
        columns = self.read().columns
        if missing := sorted(set(columns) ^ set(batch.columns)):
            raise ValueError(f"the batch and the table differ in the columns {missing}")
        # the batch is used twice; the reduced form is at most one row for each key
        held = f"{self.path}/_batch-{uuid.uuid4().hex}"
        last_puts(batch.select(*columns), self.seq).withColumn("slot", slot_of(F.col("user_id"), self.slots)).write.parquet(held)
        new = self.spark.read.parquet(held)
        touched = sorted(r.slot for r in new.select("slot").distinct().collect())  # at most ``slots`` numbers
        if touched:
            old = self.stored().filter(F.col("slot").isin(touched)).select(*columns)
            self._write(last_puts(old.unionByName(new.select(*columns)), self.seq), "overwrite")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(held)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return touched

    def of_user(self, user_id) -> DataFrame:
        """One user's rows, newest first: one folder is read."""
        rows = self.stored()
        kind = rows.schema["user_id"].dataType
        return rows.filter((F.col("slot") == slot_of(F.lit(user_id).cast(kind), self.slots))
                           & (F.col("user_id") == F.lit(user_id).cast(kind))).drop("slot").orderBy("row_key")

    def get(self, keys: DataFrame | list[str]) -> DataFrame:
        """The rows of some row keys. A list prunes folders and row groups by its values; a DataFrame
        (one column of keys) by what its rows turn out to be at run time."""
        rows = self.stored()
        if isinstance(keys, DataFrame):
            wanted = keys.toDF("row_key").distinct().withColumn("slot", slot_of(user_of_key(F.col("row_key")), self.slots))
            return rows.join(wanted, ["slot", "row_key"], "left_semi").drop("slot")
        if not keys:
            return rows.limit(0).drop("slot")
        slots = self.spark.createDataFrame([(k,) for k in keys], "k string").select(
            slot_of(user_of_key(F.col("k")), self.slots).alias("slot")).distinct().collect()
        return rows.filter(F.col("slot").isin([r.slot for r in slots]) & F.col("row_key").isin(list(keys))).drop("slot")
