"""SimHash near-dedup with pivot distance tables.

A text's fingerprint has a bit set where over half of its word shingles' hashes have it.
Every distinct fingerprint gets a row of the pivot table: its Hamming distances to
``PIVOTS`` reference fingerprints. By the triangle inequality two fingerprints within the
radius differ by no more than the radius in every coordinate, so a pair with a larger
difference in any coordinate is discarded; the pairs that survive are verified on the
fingerprints themselves.

So that pairs are not formed all with all, fingerprints are compared inside groups: the
64 bits are cut into radius + 2 blocks, at most radius of which differ in a link, so
every link agrees on two blocks and meets in the group of that pair of blocks. A group
of more than ``GROUP`` members is dealt again, in the same way, by its other bits; what
then still meets has so many equal bits that the rest bounds its size by arithmetic (at
most 2^16 distinct fingerprints at radius 2), whatever the data. No group is cut or
sampled. Inside a group the rows are sorted by their first coordinate, and each is
compared with those that follow within the radius; links are closed to components
there, so a group gives fewer edges than it has members and no pair becomes a row.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any
other; a text with fewer words than a shingle is one shingle; equal rows keep a row each;
a null doc_id never names a component that has another id; a component of null ids only
has a null id; long texts are read a megabyte at a time; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, take
from .near_dup import components
from .shingles import mix

SEED = 42
#: reference fingerprints
PIVOTS = 16
#: members of a group that are compared without dealing them again
GROUP = 1024
#: coordinates compared for whole blocks of rows, before survivors are looked at one by one
DENSE = 4
#: pairs of rows of a group compared at a time
PAIRS = 1 << 21
#: bytes of a text read at a time
PIECE_BYTES = 1 << 20
_SPACES = b" \t\n\v\f\r"
_LANES = np.uint64(0x0101010101010101)


def references() -> np.ndarray:
    """Fixed reference fingerprints without visible structure."""
    return mix(np.arange(1, PIVOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(data):
        end = at + PIECE_BYTES
        while end < len(data) and data[end] not in _SPACES:
            end += 1
        yield data[at:end].lower().split()
        at = end


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words joined by spaces; of fewer words, of all of them."""
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a:b - 1], SEED) for a, b in zip(starts, ends[size - 1:], strict=False)], np.uint64)


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of ``h`` have each of the 64 bits: eight counters of a byte at a time, 255 numbers each."""
    out = np.zeros((8, 8), np.int64)
    at = np.arange(0, len(h), 255)
    for s in range(8):
        lanes = np.add.reduceat((h >> np.uint64(s)) & _LANES, at)
        out[:, s] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.reshape(64)


def fingerprint(data: bytes, size: int) -> int:
    """The 64-bit fingerprint of a UTF-8 text; zero without words."""
    total, n, carry = np.zeros(64, np.int64), 0, []
    for words in pieces(data):
        words = carry + words
        if len(words) >= size:
            h = shingle_hashes(words, size)
            total += bit_counts(h)
            n += len(h)
            carry = words[len(words) - size + 1:]
        else:
            carry = words
    if not n and carry:
        total, n = bit_counts(shingle_hashes(carry, size)), 1
    return int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, fp) of each row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), words) for t in b["data"]], np.uint64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    data = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data")
    return docs.select("doc_id", data).mapInArrow(run, "doc_id bigint, fp bigint")


def pivot_table(fps: DataFrame) -> DataFrame:
    """``fps`` with ``d``: the Hamming distance to each reference."""
    return fps.withColumn("d", F.array(*[
        F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(p)))).cast("tinyint") for p in references().view(np.int64)]))


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    return [bits[k * len(bits) // parts:(k + 1) * len(bits) // parts] for k in range(parts)]


def _bits(mask: list[int]) -> Column:
    value = sum(1 << b for b in mask)
    return F.col("fp").bitwiseAND(F.lit(value - (1 << 64) if value >> 63 else value))


def _meetings(radius: int) -> list[tuple[list[int], list[int]]]:
    """(bits that agree, other bits) of each pair of blocks."""
    out = []
    for pair in combinations(_cut(list(range(64)), radius + 2), 2):
        mine = pair[0] + pair[1]
        out.append((mine, [b for b in range(64) if b not in mine]))
    return out


def _grouped(rows: DataFrame) -> DataFrame:
    """``rows`` (fp, t, key) with the ``members`` of their group, where it has more than one."""
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("members")).filter("members > 1")
    return rows.join(sizes, ["t", "key"])


def closed(n: int, i: np.ndarray, j: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``label`` (the least known member of each of ``n`` rows' components) after the links i - j."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def linked(fp: np.ndarray, d: np.ndarray, radius: int) -> np.ndarray:
    """For each row of a group the number of the first row of its component."""
    order = np.argsort(d[:, 0], kind="stable")
    fp, d = fp[order], d[order]
    n = len(fp)
    until = np.searchsorted(d[:, 0], d[:, 0] + radius, side="right")
    label = np.arange(n)
    step = max(1, PAIRS // n)
    for k in range(0, n, step):
        end = min(k + step, n)
        far = until[end - 1]
        near = np.arange(k, end)[:, None] < np.arange(k, far)
        for c in range(DENSE):
            near &= np.abs(d[k:end, c, None] - d[k:far, c]) <= radius
        i, j = np.nonzero(near)
        i, j = i + k, j + k
        keep = (np.abs(d[i, DENSE:] - d[j, DENSE:]) <= radius).all(axis=1)
        i, j = i[keep], j[keep]
        keep = np.bitwise_count(fp[i] ^ fp[j]) <= radius
        label = closed(n, i[keep], j[keep], label)
    out = np.empty(n, np.int64)
    out[order] = order[label]
    return out


def _compared(groups: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) that connect each group's components. ``groups``: (t, key, fp, d)."""
    def edges(key: np.ndarray, fp: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
        """Of rows sorted by group."""
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        size = np.diff(np.r_[first, len(key)])
        a, b = [], []
        at = first[size == 2]
        ok = (np.abs(d[at] - d[at + 1]) <= radius).all(axis=1)
        at = at[ok]
        at = at[np.bitwise_count(fp[at] ^ fp[at + 1]) <= radius]
        a.append(fp[at])
        b.append(fp[at + 1])
        for k, n in zip(first[size > 2], size[size > 2], strict=True):
            mine = fp[k:k + n]
            root = linked(mine, d[k:k + n], radius)
            child = np.flatnonzero(root != np.arange(n))
            a.append(mine[child])
            b.append(mine[root[child]])
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []  # of the last group so far
        for b in batches:
            key = np.column_stack([b["t"].to_numpy().astype(np.int64), b["key"].to_numpy()])
            fp = b["fp"].to_numpy().view(np.uint64)
            d = b["d"].flatten().to_numpy().reshape(-1, PIVOTS)
            if not len(key):
                continue
            ends = np.flatnonzero((key != key[-1]).any(axis=1))
            cut = ends[-1] + 1 if len(ends) else 0
            if held and (cut or (held[-1][0][-1] != key[-1]).any()):
                # the group held so far ends in this batch
                parts = [*held, (key[:cut], fp[:cut], d[:cut])]
                yield edges(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                held = []
            elif cut:
                yield edges(key[:cut], fp[:cut], d[:cut])
            held.append((key[cut:], fp[cut:], d[cut:]))
        if held:
            yield edges(*(np.concatenate(x) for x in zip(*held, strict=True)))

    dealt = groups.select("t", "key", "fp", "d").repartition("t", "key").sortWithinPartitions("t", "key")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fps`` (fp, d) as their links within ``radius`` do."""
    meetings = _meetings(radius)
    keys = F.array(*[F.struct(F.lit(t).alias("t"), _bits(mine).alias("key")) for t, (mine, _) in enumerate(meetings)])
    rows = fps.select("fp", "d", F.explode(keys).alias("m")).select("fp", "d", "m.t", "m.key")
    groups = stored(_grouped(rows), "op13-groups")
    # a large group once more, by two of the blocks of its other bits
    again = []
    for t, (mine, others) in enumerate(meetings):
        for u, (x, y) in enumerate(combinations(_cut(others, radius + 2), 2)):
            again.append(F.struct(F.lit(t).alias("of"), F.lit(100 * (t + 1) + u).alias("t"), _bits(mine + x + y).alias("key")))
    large = groups.filter(F.col("members") > GROUP).select("fp", "d", "t", F.explode(F.array(*again)).alias("m"))
    large = large.filter("t = m.of").select("fp", "d", "m.t", "m.key")
    small = groups.filter(F.col("members") <= GROUP)
    return _compared(small.unionByName(_grouped(large), allowMissingColumns=True), radius)


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) of each row of ``docs`` (doc_id, text): component_id is the smallest
    doc_id that links reach."""
    of_docs = stored(fingerprints(take(docs, doc_id="bigint", text="string"), words), "op13-fingerprints")
    distinct = of_docs.groupBy("fp").agg(F.min("doc_id").alias("least"))
    fps = stored(pivot_table(distinct), "op13-pivots")
    labels = components(stored(links(fps, radius).distinct(), "op13-links"))
    per_fp = fps.select("fp", "least").join(labels.withColumnRenamed("c", "fp"), "fp", "left").withColumn(
        "label", F.coalesce("label", "fp"))
    groups = per_fp.groupBy("label").agg(F.min("least").alias("component_id"))
    found = per_fp.join(groups, "label").select("fp", "component_id")
    return of_docs.join(found, "fp").select("doc_id", "fp", "component_id")


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
