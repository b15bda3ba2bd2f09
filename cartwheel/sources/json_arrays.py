"""Files that hold one JSON array: read by many tasks, written back as they were.

Spark's JSON reader takes such a file in one task, since the start of an element can
only be told from all that comes before it. Here the file is scanned as text in
ordinary splits (``lineSep`` ``}``, so every scheme that Spark reads works), in two steps:

1. Each split is summarised without knowing how it begins: how its quotes change the
   in-string state, and how its brackets change the depth and where its commas lie, for
   either state it may begin in. One row for each split; running sums over a file's splits
   give the state, the depth and the number of commas at which each split begins.
2. Each split is scanned again from its known beginning. Elements that lie within it are
   emitted; the two pieces at its ends go with the number of their element, and pieces of
   one element, from as many splits as it spans, are joined in order.

Every element then goes through ``from_json`` with the explicit schema. No split depends on
another's scan, no file is held whole, and the reader is a lazy plan: a broken file is
found when it is read.

Errors (never lost rows): a file that does not begin with ``[``, is cut off, does not
close its brackets or strings, goes on after the array, or has an empty element; an
element that is no object, or does not fit the schema.

The writer puts at most ``per_file`` rows into each file, each file being one array on
one line.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# functions that run in tasks are shipped by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PER_FILE = 100_000
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

#: the text between two of these is a row of the scan
CUT = b"}"
QUOTE, BACKSLASH, COMMA = 34, 92, 44
#: depth change by byte; commas have none but are looked at
CHANGE = np.zeros(256, np.int8)
CHANGE[[ord("["), ord("{")]] = 1
CHANGE[[ord("]"), ord("}")]] = -1
LOOKED_AT = CHANGE != 0
LOOKED_AT[COMMA] = True

SUMMARY = ("file string, start bigint, file_size bigint, bytes bigint, quotes bigint, change0 bigint, change1 bigint, "
           "commas0 map<bigint,bigint>, commas1 map<bigint,bigint>")
PIECES = "file string, element bigint, start bigint, whole boolean, last boolean, text string"
#: white space of JSON
BLANK = " \t\r\n"


def _scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(data, file, start, file_size): the pieces up to each closing brace, in file order within a split. A
    brace is put behind the last piece of a file, too."""
    return spark.read.option("lineSep", CUT.decode()).text(paths).select(
        F.concat(F.col("value").cast("binary"), F.lit(CUT)).alias("data"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("file_size"))


def structure(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the brackets and commas of ``data``, how many open quotes precede each, and the
    positions of all quotes that no backslash escapes. ``data`` does not begin behind a backslash."""
    a = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(a == QUOTE)
    if BACKSLASH in data and len(quotes):
        plain = np.where(a != BACKSLASH, np.arange(len(a)), -1)
        last = np.maximum.accumulate(plain)  # the last byte up to here that is no backslash
        before = np.where(quotes > 0, last[np.maximum(quotes - 1, 0)], -1)
        quotes = quotes[(quotes - 1 - before) % 2 == 0]
    at = np.flatnonzero(LOOKED_AT[a])
    return at, np.searchsorted(quotes, at), quotes


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """((file, start, ...), bytes) of each run of rows of one split: the rows of an Arrow batch lie behind
    one another in one buffer, no row is taken out on its own."""
    for b in batches:
        if not b.num_rows:
            continue
        data = b["data"]
        kind = np.int64 if pa.types.is_large_binary(data.type) else np.int32
        offsets = np.frombuffer(data.buffers()[1], kind)[data.offset:data.offset + len(data) + 1]
        text = memoryview(data.buffers()[2])
        others = [b[c] for c in b.schema.names if c != "data"]
        start, file = b["start"].to_numpy(), b["file"].dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero((start[1:] != start[:-1]) | (file[1:] != file[:-1])) + 1
        for x, y in zip([0, *edges], [*edges, b.num_rows], strict=True):
            yield tuple(c[int(x)].as_py() for c in others), bytes(text[offsets[x]:offsets[y]])


class Summary:
    """What a split does to the state it begins in, whichever that is."""

    def __init__(self):
        self.bytes, self.quotes = 0, 0
        self.change = [0, 0]
        self.commas: list[dict[int, int]] = [{}, {}]

    def add(self, data: bytes) -> None:
        at, before, quotes = structure(data)
        a = np.frombuffer(data, np.uint8)
        for state in (0, 1):
            outside = (before + self.quotes + state) % 2 == 0
            kinds = a[at[outside]]
            depth = self.change[state] + np.cumsum(CHANGE[kinds], dtype=np.int64)
            levels, counts = np.unique(depth[kinds == COMMA], return_counts=True)
            for d, n in zip(levels.tolist(), counts.tolist(), strict=True):
                self.commas[state][d] = self.commas[state].get(d, 0) + n
            if len(depth):
                self.change[state] = int(depth[-1])
        self.quotes += len(quotes)
        self.bytes += len(data)


def split_summaries(scan: DataFrame) -> DataFrame:
    """One row of ``SUMMARY`` for each split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["file", "start", "file_size", "bytes", "quotes", "change0", "change1", "commas0", "commas1"]
        numbers = pa.map_(pa.int64(), pa.int64())
        kinds = [pa.string(), *[pa.int64()] * 6, numbers, numbers]

        def row(key: tuple, s: Summary) -> pa.RecordBatch:
            values = [*key, s.bytes, s.quotes, *s.change, *(list(c.items()) for c in s.commas)]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=fields)

        held, of = None, None
        for key, data in _buffers(batches):
            if key != of:
                if held:
                    yield row(of, held)
                held, of = Summary(), key
            held.add(data)
        if held:
            yield row(of, held)

    return scan.mapInArrow(run, SUMMARY)


def split_states(summaries: DataFrame) -> DataFrame:
    """(file, start, state, depth, element, broken) at which each split begins. One row for each split, as
    in the driver's own list of splits, so it may be broadcast."""
    order = Window.partitionBy("file").orderBy("start")
    before, all_ = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")

    def so_far(c) -> F.Column:
        return F.coalesce(F.sum(c).over(before), F.lit(0))

    def picked(name: str) -> F.Column:
        return F.when(F.col("state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    s = summaries.withColumn("state", so_far("quotes") % 2)
    s = s.withColumns({"change": picked("change"), "by_depth": picked("commas")})
    s = s.withColumn("depth", so_far("change"))
    # commas of the array itself: at depth 1
    s = s.withColumn("commas", F.coalesce(F.try_element_at("by_depth", 1 - F.col("depth")), F.lit(0)))
    # the scan puts a brace behind the last row of a file, which the file does not have
    added = F.sum("bytes").over(all_) != F.col("file_size")
    broken = ~added | (F.sum("change").over(all_) != -1) | (F.sum("quotes").over(all_) % 2 != 0)
    return s.select("file", "start", F.col("state").cast("bigint").alias("state"), F.col("depth").cast("bigint").alias("depth"),
                    so_far("commas").cast("bigint").alias("element"), broken.alias("broken"))


class Cutter:
    """Cuts one split, from its known beginning, into elements and the pieces at its ends."""

    def __init__(self, file: str, state: int, depth: int, element: int):
        self.file, self.quotes, self.depth, self.element = file, state, depth, element
        self.whole = False  # whether the piece now being gathered began in this split
        self.piece: list[bytes] = []

    def _fail(self, what: str) -> None:
        raise ValueError(f"{self.file}: {what}")

    def _blank(self, data: bytes, what: str) -> None:
        if data.strip(BLANK.encode()):
            self._fail(what)

    def add(self, data: bytes) -> Iterator[tuple[int, bool, bool, bytes]]:
        """(element, whole, whether the array closes behind it, text) of what ends in ``data``."""
        at, before, quotes = structure(data)
        a = np.frombuffer(data, np.uint8)
        at = at[(before + self.quotes) % 2 == 0]
        kinds = a[at]
        change = CHANGE[kinds]
        depth = self.depth + np.cumsum(change, dtype=np.int64)
        # the array opens, has a comma, or closes
        edge = (depth - change == 0) | ((depth == 1) & (kinds == COMMA)) | ((depth == 0) & (change < 0))
        done = 0
        for pos, kind, now, delta in zip(at[edge].tolist(), kinds[edge].tolist(), depth[edge].tolist(), change[edge].tolist(), strict=True):
            if now - delta == 0:
                if now == -1 and kind == CUT[0]:
                    # behind the array: the brace that the scan has put there
                    self._blank(data[done:pos], "text after the array")
                elif kind != ord("[") or self.element or self.piece:
                    self._fail("not one array")
                else:
                    self._blank(data[done:pos], "text before the array")
                    self.whole = True
            else:
                if now == 0 and kind != ord("]"):
                    self._fail("the array is closed by a brace")
                yield self.element, self.whole, now == 0, b"".join([*self.piece, data[done:pos]])
                self.piece, self.whole = [], kind == COMMA
                self.element += kind == COMMA
            done = pos + 1
        if len(depth):
            self.depth = int(depth[-1])
        self.quotes += len(quotes)
        if self.depth >= 1:
            self.piece.append(data[done:])
        else:
            self._blank(data[done:], "text outside the array")

    def rest(self) -> Iterator[tuple[int, bool, bool, bytes]]:
        if self.piece:
            yield self.element, False, False, b"".join(self.piece)


def array_elements(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, element, text): each element of the arrays in the files, by its number, as JSON text; text is
    blank where an element is missing."""
    states = split_states(split_summaries(_scan(spark, paths)))

    def pieces(whole_wanted: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows(found: list[tuple[int, bool, bool, bytes]], file: str, start: int) -> pa.RecordBatch:
                # whole elements are stripped here, pieces when they are joined
                found = [(*x[:3], x[3].strip(BLANK.encode()) if whole_wanted else x[3]) for x in found if x[1] == whole_wanted]
                return pa.RecordBatch.from_arrays([
                    pa.array([file] * len(found), pa.string()), pa.array([x[0] for x in found], pa.int64()),
                    pa.array([start] * len(found), pa.int64()), pa.array([x[1] for x in found], pa.bool_()),
                    pa.array([x[2] for x in found], pa.bool_()), pa.array([x[3].decode("utf-8", "replace") for x in found], pa.string())],
                    names=["file", "element", "start", "whole", "last", "text"])

            held, of = None, None
            for key, data in _buffers(batches):
                if key != of:
                    if held:
                        yield rows(list(held.rest()), *of[:2])
                    file, start, state, depth, element, broken = key
                    if state is None:
                        raise ValueError(f"{file}: the splits changed while it was read")
                    if broken:
                        raise ValueError(f"{file}: not one complete JSON array")
                    held, of = Cutter(file, state, depth, element), key
                yield rows(list(held.add(data)), *of[:2])
            if held:
                yield rows(list(held.rest()), *of[:2])

        # a broadcast join keeps the rows of the scan in their order
        known = _scan(spark, paths).drop("file_size").join(F.broadcast(states), ["file", "start"], "left")
        return known.select("data", "file", "start", "state", "depth", "element", "broken").mapInArrow(run, PIECES)

    # an element in two splits or more has a piece from each; the pieces are bytes of one text
    joined = pieces(False).groupBy("file", "element").agg(
        F.array_sort(F.collect_list(F.struct("start", "text"))).alias("parts"), F.bool_or("last").alias("last"))
    joined = joined.select("file", "element", "last", F.btrim(F.array_join("parts.text", ""), F.lit(BLANK)).alias("text"))
    every = pieces(True).select("file", "element", "last", "text").unionByName(joined)
    # nothing between the brackets: an empty array
    return every.filter(~((F.col("text") == "") & (F.col("element") == 0) & F.col("last"))).drop("last")


def read_arrays(spark: SparkSession, paths: list[str], schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """The documents of files that hold one JSON array each. An empty array has no documents;
    a broken element is an error, or nulls with ``mode="PERMISSIVE"``."""
    if not paths:
        return spark.createDataFrame([], schema)
    document = F.when(F.col("text").startswith("{"), F.col("text"))
    if mode == "FAILFAST":
        document = document.otherwise(F.raise_error(F.format_string(
            "%s: element %d of the array is no object", "file", "element")).cast("string"))
    return array_elements(spark, paths).select(F.from_json(document, schema, {"mode": mode}).alias("doc")).select("doc.*")


def holds_array(spark: SparkSession, path: str) -> bool:
    """Whether the file begins with ``[`` (one small read on the driver)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        byte = stream.read()
        while byte in b"\xef\xbb\xbf" + BLANK.encode():  # -1 at the end
            byte = stream.read()
        return byte == ord("[")
    finally:
        stream.close()


def write_arrays(df: DataFrame, folder: str, name: str, per_file: int = PER_FILE, layout: str = "arrays") -> list[str]:
    """Writes the rows of ``df`` as files ``<name>_<k>.json`` in ``folder``, each one JSON array (or, by
    ``layout``, ``lines``) of at most ``per_file`` documents; returns their paths. Files of an earlier
    export of the name are replaced."""
    return write_texts(json_texts(df), folder, name, per_file, layout)


def json_texts(df: DataFrame) -> DataFrame:
    """(value): each row as the text of a JSON object."""
    return df.select(json_text(df.columns).alias("value"))


def json_text(columns: list[str]) -> Column:
    """A row's columns as the text of a JSON object."""
    options = {"ignoreNullFields": "false", "timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_FORMAT}
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), options)


def write_texts(texts: DataFrame, folder: str, name: str, per_file: int = PER_FILE, layout: str = "arrays") -> list[str]:
    """``write_arrays`` for documents that are JSON text already (one column, ``value``).

    Tasks write under a folder of their own; its files are then renamed one by one, so an
    export that fails in its tasks leaves the earlier one as it was."""
    spark = texts.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Opens an array at each file's first row and closes it at its last."""
        n, held = 0, None
        for b in batches:
            out = []
            for text in b["value"].to_pylist():
                if held is not None:
                    out.append(held + ("]" if n % per_file == 0 else ","))
                held = ("[" if n % per_file == 0 else "") + text
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held + "]"], pa.string())], names=["value"])

    root = folder.rstrip("/")
    staged = f"{root}/_{name}-{uuid.uuid4().hex}"
    arrays = layout == "arrays"
    # a task starts a new file after as many rows as the array in it has
    rows = texts.mapInArrow(run, "value string") if arrays else texts
    rows.write.option("maxRecordsPerFile", per_file).option("lineSep", " " if arrays else "\n").text(staged)

    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def written() -> list[str]:
        return sorted(f.getPath().toString() for f in fs.listStatus(path(staged))
                      if f.getLen() and f.getPath().getName().startswith("part-"))

    parts = written()
    if not parts and arrays:
        spark.createDataFrame([("[]",)], "value string").coalesce(1).write.mode("overwrite").text(staged)
        parts = written()
    for f in fs.globStatus(path(f"{root}/{name}_*.json")) or []:
        fs.delete(f.getPath(), False)
    out = []
    for k, part in enumerate(parts):
        out.append(f"{root}/{name}_{k}.json")
        if not fs.rename(path(part), path(out[-1])):
            raise OSError(f"could not rename {part} to {out[-1]}")
    fs.delete(path(staged), True)
    return out
