"""The newest sessions of each user, kept up to date over a stream of puts.

A put overwrites the row of its key; of several puts of a key the one with the largest
sequence number holds, whatever order they arrive in. The state is, for each user, a list
of the ``n`` smallest row keys (newest first) with their last puts. Keys are never
taken away, so a key that has left the list does not come back and the list is all the state
that is needed. Any split of the input into files and micro-batches gives the batch answer.

Each task first reduces every Arrow batch of puts to the ``n`` newest keys of each user in it, with
their last puts: a user with a third of all puts sends ``n`` rows a batch, and is one short
list's work. ``parts`` lists a user, by a hash of the key, are for users whose rows are too many
even so; every list is a call of Python, so one is the rule. A list holds ``n`` rows at most, and
a micro-batch is folded into it one Arrow batch at a time.

Each micro-batch emits only rows that are new in a list or changed. They go to a folder of
their own (``batch=<id>``), written over when the micro-batch is run again after a failure;
``newest`` reads the folders, takes each key's last put and each user's first n keys.

Puts without a key or a user are ignored; a put without a sequence number counts as the
oldest; of puts equal in key and number the one whose JSON text is largest stays.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cartwheel.operators.timeline import _newest_first
from cartwheel.operators.timeline_store import last_puts
from cartwheel.sources.json_arrays import TS_FORMAT

# functions that run in tasks are shipped by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTS = 1
OLDEST = -(1 << 63)
COLUMNS = ["row_key", "seq", "cells"]
ZONED = f"{TS_FORMAT}XXX"
LISTS = "owner string, row_key string, seq bigint, cells string"
STATE = "keys array<string>, seqs array<bigint>, cells array<string>"


def condensed(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` (owner, row_key, seq, cells ...) without those that cannot stay in a list, as far as one
    Arrow batch tells: of each owner the ``n`` smallest keys, each with its last put."""
    order = [(c, "ascending") for c in ("owner", "row_key", "seq", "cells")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            at = pc.sort_indices(b, sort_keys=order).to_numpy()
            owner, key = (b[c].dictionary_encode().indices.to_numpy()[at] for c in ("owner", "row_key"))
            ends = np.r_[(owner[1:] != owner[:-1]) | (key[1:] != key[:-1]), True]
            at, owner = at[ends], owner[ends]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
            yield b.take(pa.array(at[rank < n]))

    return rows.mapInArrow(run, rows.schema)


def fold(held: dict[str, tuple[int, str]], puts: pd.DataFrame, n: int) -> dict[str, tuple[int, str]]:
    """The ``n`` smallest keys of both in order, each with its last put (seq, cells)."""
    both = dict(held)
    for key, *put in zip(*(puts[c].tolist() for c in COLUMNS), strict=True):
        put = tuple(put)
        if key not in both or both[key] < put:
            both[key] = put
    return {key: both[key] for key in heapq.nsmallest(n, both)}


def _update(n: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = {k: (seq, cells) for k, seq, cells in zip(*state.get, strict=True)} if state.exists else {}
        held = before
        for b in batches:
            held = fold(held, b, n)
        state.update((list(held), [put[0] for put in held.values()], [put[1] for put in held.values()]))
        new = [(key[0], k, *put) for k, put in held.items() if before.get(k) != put]
        yield pd.DataFrame(new, columns=["owner", *COLUMNS])

    return run


def newest_stream(puts: DataFrame, n: int, seq: str = "put_seq", parts: int = PARTS) -> DataFrame:
    """``puts``: a stream of (row_key, user_id, ``seq``, any others). A stream, in update mode, of the puts that
    enter the lists, with the columns of ``puts``."""
    cells = T.StructType([puts.schema[c] for c in puts.columns])
    formats = {"timestampFormat": ZONED, "timestampNTZFormat": TS_FORMAT}
    rows = puts.filter("row_key is not null and user_id is not null").select(
        F.col("user_id").cast("string").alias("owner"), "row_key", F.coalesce(F.col(seq), F.lit(OLDEST)).cast("bigint").alias("seq"),
        F.to_json(F.struct(*puts.columns), {"ignoreNullFields": "false", **formats}).alias("cells"),
        F.pmod(F.xxhash64("row_key"), F.lit(parts)).alias("part"))
    lists = condensed(rows, n).groupBy("owner", "part").applyInPandasWithState(
        _update(n), LISTS, STATE, "update", GroupStateTimeout.NoTimeout)
    return lists.select(F.from_json("cells", cells, {"mode": "FAILFAST", **formats}).alias("r")).select("r.*")


def start(entered: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Writes each micro-batch of ``newest_stream`` under ``path``. A query started again with the same
    checkpoint goes on where it stopped; a micro-batch that is repeated replaces its own folder."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    w = entered.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (w.trigger(availableNow=True) if available_now else w).start()


def newest(spark: SparkSession, path: str, schema: T.StructType, n: int, seq: str = "put_seq") -> DataFrame:
    """The newest ``n`` rows of each user, with recency_rank, from what the stream has written so far (nothing
    before its first micro-batch)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return _newest_first(spark.createDataFrame([], schema), n)
    rows = spark.read.schema(schema).option("basePath", path).parquet(path).select(*schema.fieldNames())
    return _newest_first(last_puts(rows, seq), n)
