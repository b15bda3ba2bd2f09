"""Centroid clustering over a VA-file.

Each vector is kept twice in one stored table: as whole numbers, and as an approximation
of 4 bits for each dimension, the cell its component falls in. The cells' edges are
quantiles of a bounded sample; they decide how tight the intervals are, never a result.

A centroid's lookup table gives, for each dimension and cell, the least and the largest
squared difference to any number of the cell; summed over the dimensions these bound the
distance of a vector from its approximation alone. A vector is settled where the upper
bound of one centroid is not above the lower bound of every other. Only vectors whose
intervals overlap, or whose cluster changes, are fetched whole, by a join on the row
number, and compared exactly with the centroids that are still possible.

A round's sums are those of the round before, plus what changed clusters; so whole
vectors are read by the first round (its sums need them), for the few fetched after it,
and once at the end for the distances that are returned.

The driver holds centroids, sums and inertias (k times the number of dimensions), and the
sample of ``SAMPLE`` vectors; sums are exact.

Defined cases: vectors that are null, of another length, or with a component that is null
or not finite are left out; a null vec_id hashes as the empty string and is returned;
rows that repeat are vectors of their own; equal hashes are ordered by vec_id, then by
components; fewer vectors than centroids give fewer centroids; no vectors give no rows;
components beyond +-2^26 after scaling count as that bound (so that every distance is an
exact 64-bit number), an inertia beyond 2^63 - 1 as that number.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, take

#: numbers are clamped to this, so that sums of squares fit 64 bits
LIMIT = 1 << 26
#: cells of a dimension: 4 bits
CELLS = 16
#: vectors (expected number) that the cells' edges are taken from
SAMPLE = 4096
LARGEST = 2**63 - 1


class Clustering(NamedTuple):
    #: (vec_id, cluster, distance), stored
    assigned: DataFrame
    #: one row of whole numbers for each centroid
    centroids: np.ndarray
    #: distance summed over each cluster
    inertia: dict[int, int]
    #: vectors fetched whole in each round after the first
    fetched: list[int]


def kept_vectors(rows: DataFrame, dims: int) -> DataFrame:
    """(row, vec_id, x array<double>) of the vectors that count; row is a number of its own."""
    plain = take(rows, vec_id="bigint", embedding="array<double>").withColumnRenamed("embedding", "x")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return plain.filter((F.size("x") == dims) & finite).select(F.monotonically_increasing_id().alias("row"), "vec_id", "x")


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(np.clip(x * scale, -LIMIT, LIMIT)).astype(np.int64)


def _components(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def packed(v: np.ndarray) -> pa.Array:
    """Whole numbers as bytes, in the narrowest width that holds all of them."""
    width = next(w for w in (1, 2, 4) if not len(v) or np.abs(v).max() < 1 << (8 * w - 1))
    data = np.ascontiguousarray(v.astype(f"<i{width}"))
    offsets = np.arange(len(v) + 1, dtype=np.int32) * (width * v.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpacked(column: pa.Array, dims: int) -> np.ndarray:
    out = np.empty((len(column), dims), np.int64)
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        data = b"".join(column.take(pa.array(at)).to_pylist())
        out[at] = np.frombuffer(data, f"<i{n // dims}").reshape(-1, dims)
    return out


def edges_of(sample: np.ndarray) -> np.ndarray:
    """For each dimension the least number of cells 1, 2, ...: the outer cells lie beyond the sample,
    the others hold equal shares of it."""
    if not len(sample):
        return np.zeros((sample.shape[1], CELLS - 1), np.int64)
    s = np.sort(sample, axis=0)
    at = np.arange(CELLS - 2) * len(s) // (CELLS - 2)
    return np.vstack([s[at], s[-1:] + 1]).T.copy()


def cells_of(v: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = np.empty(v.shape, np.uint8)
    for d in range(v.shape[1]):
        out[:, d] = np.searchsorted(edges[d], v[:, d], side="right")
    return out


def cells_packed(cells: np.ndarray) -> pa.Array:
    """Two cells a byte."""
    even = np.pad(cells, ((0, 0), (0, cells.shape[1] % 2)))
    return packed((even[:, ::2] | (even[:, 1::2] << 4)).view(np.int8))


def cells_unpacked(column: pa.Array, dims: int) -> np.ndarray:
    both = unpacked(column, (dims + 1) // 2).astype(np.uint8)
    out = np.empty((len(both), 2 * both.shape[1]), np.uint8)
    out[:, ::2], out[:, 1::2] = both & 15, both >> 4
    return out[:, :dims]


def lookup(centroids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) squared difference by (dimension, cell, centroid)."""
    dims = len(edges)
    first = np.hstack([np.full((dims, 1), -LIMIT), edges])[:, :, None]
    last = np.hstack([edges - 1, np.full((dims, 1), LIMIT)])[:, :, None]
    c = centroids.T[:, None, :]
    outside = np.maximum(np.maximum(first - c, c - last), 0)
    return outside**2, np.maximum(np.abs(c - first), np.abs(c - last))**2


def possible(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which centroids (columns) can be the nearest of each vector (rows), by its cells alone."""
    low = np.zeros((len(cells), tables[0].shape[2]), np.int64)
    high = np.zeros_like(low)
    for d in range(cells.shape[1]):
        low += tables[0][d][cells[:, d]]
        high += tables[1][d][cells[:, d]]
    best = high.argmin(axis=1)
    bound = high[np.arange(len(cells)), best][:, None]
    number = np.arange(low.shape[1])
    # a tie goes to the smaller number
    return (low < bound) | ((low == bound) & (number <= best[:, None])) | (number == best[:, None])


def nearest(v: np.ndarray, open_: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest possible centroid of each vector: exact distances only where more than one is possible."""
    out = open_.argmax(axis=1)
    many = np.flatnonzero(open_.sum(axis=1) > 1)
    if len(many):
        best = np.full(len(many), LARGEST)
        for k in range(len(centroids)):
            at = np.flatnonzero(open_[many, k])
            far = ((v[many[at]] - centroids[k])**2).sum(axis=1)
            nearer = far < best[at]
            out[many[at[nearer]]] = k
            best[at[nearer]] = far[nearer]
    return out


def _in_pieces(batches: Iterator[pa.RecordBatch], size: int = 4096) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, size):
            yield b.slice(k, size)


def _totals(changes: DataFrame, k: int, dims: int) -> np.ndarray:
    """Sums of (cluster, dim, total) rows as exact whole numbers; column ``dims`` counts vectors."""
    out = np.zeros((k, dims + 1), object)
    for r in changes.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        out[r.cluster, r.dim] = int(r.total)
    return out


def _rows_of(sums: np.ndarray) -> pa.RecordBatch:
    at = np.argwhere(sums)
    return pa.RecordBatch.from_arrays(
        [pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array(sums[tuple(at.T)], pa.int64())],
        names=["cluster", "dim", "total"])


def _add(sums: np.ndarray, v: np.ndarray, cluster: np.ndarray, sign: int) -> None:
    for k in np.unique(cluster):
        mine = v[cluster == k]
        sums[k, :-1] += sign * mine.sum(axis=0)
        sums[k, -1] += sign * len(mine)


CHANGES = "cluster int, dim int, total bigint"


def _first_sums(va: DataFrame, centroids: np.ndarray, edges: np.ndarray) -> np.ndarray:
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, sums = lookup(centroids, edges), np.zeros((k, dims + 1), np.int64)
        for b in _in_pieces(batches):
            v = unpacked(b["v"], dims)
            _add(sums, v, nearest(v, possible(cells_unpacked(b["cells"], dims), tables), centroids), 1)
        yield _rows_of(sums)

    return _totals(va.select("cells", "v").mapInArrow(run, CHANGES), k, dims)


def _changed_sums(va: DataFrame, old: np.ndarray, new: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, int]:
    """What the sums change by when ``new`` centroids follow ``old`` ones, and how many vectors were fetched."""
    k, dims = new.shape

    def unsettled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, after = lookup(old, edges), lookup(new, edges)
        for b in _in_pieces(batches):
            cells = cells_unpacked(b["cells"], dims)
            p, q = possible(cells, before), possible(cells, after)
            same = (p.sum(axis=1) == 1) & (p == q).all(axis=1)
            yield pa.RecordBatch.from_arrays([b["row"].filter(pa.array(~same))], names=["row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, after, sums = lookup(old, edges), lookup(new, edges), np.zeros((k, dims + 1), np.int64)
        for b in _in_pieces(batches):
            v, cells = unpacked(b["v"], dims), cells_unpacked(b["cells"], dims)
            x, y = nearest(v, possible(cells, before), old), nearest(v, possible(cells, after), new)
            moved = x != y
            _add(sums, v[moved], x[moved], -1)
            _add(sums, v[moved], y[moved], 1)
        yield _rows_of(sums)

    # read by the join and by the count
    wanted = stored(va.select("row", "cells").mapInArrow(unsettled, "row bigint"), "op12-unsettled")
    fetched = va.select("row", "cells", "v").join(wanted, "row").select("cells", "v")
    return _totals(fetched.mapInArrow(run, CHANGES), k, dims), wanted.count()


def va_file(rows: DataFrame, dims: int, scale: int) -> tuple[DataFrame, np.ndarray]:
    """The stored table (row, vec_id, cells, v), and the edges of its cells."""
    kept = kept_vectors(rows, dims)
    one_in = max(1, rows.count() // SAMPLE)
    drawn = kept.filter(F.pmod(F.xxhash64("row"), F.lit(one_in)) == 0).limit(2 * SAMPLE).select("x").collect()
    edges = edges_of(scaled(np.array([r.x for r in drawn], float).reshape(-1, dims), scale))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _in_pieces(batches):
            v = scaled(_components(b["x"], dims), scale)
            yield pa.RecordBatch.from_arrays(
                [b["row"], b["vec_id"], cells_packed(cells_of(v, edges)), packed(v)], names=["row", "vec_id", "cells", "v"])

    return stored(kept.mapInArrow(run, "row bigint, vec_id bigint, cells binary, v binary"), "op12-va"), edges


def cluster(rows: DataFrame, dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3,
            order: Column | None = None) -> Clustering | None:
    """Clusters of the column ``embedding`` of ``rows`` (vec_id, embedding); None without vectors.

    The centroids start as the ``k`` vectors that come first by ``order`` (a string column
    over vec_id), by default the sha256 of ``1:<vec_id>``."""
    va, edges = va_file(rows, dims, scale)
    if order is None:
        order = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    # bytes of one width order like the numbers once the sign bit is flipped; ties need any fixed order only
    first = va.select(order.alias("o"), "vec_id", "v").orderBy("o", "vec_id", F.hex("v")).limit(k).collect()
    if not first:
        return None
    centroids = unpacked(pa.array([bytes(r.v) for r in first], pa.binary()), dims)
    sums, fetched, old = None, [], None
    for _ in range(rounds):
        if sums is None:
            sums = _first_sums(va, centroids, edges)
        else:
            change, n = _changed_sums(va, old, centroids, edges)
            sums = sums + change
            fetched.append(n)
        old, centroids = centroids, centroids.copy()
        for c in range(len(centroids)):
            if sums[c, -1]:
                centroids[c] = [int(s) // int(sums[c, -1]) for s in sums[c, :-1]]

    final = centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = lookup(final, edges)
        for b in _in_pieces(batches):
            v = unpacked(b["v"], dims)
            c = nearest(v, possible(cells_unpacked(b["cells"], dims), tables), final)
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], pa.array(c, pa.int32()), pa.array(((v - final[c])**2).sum(axis=1), pa.int64())],
                names=["vec_id", "cluster", "distance"])

    assigned = stored(va.select("vec_id", "cells", "v").mapInArrow(run, "vec_id bigint, cluster int, distance bigint"), "op12-assigned")
    sizes = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    return Clustering(assigned, centroids, {r.cluster: int(r.s) for r in sizes}, fetched)


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(table(spark, sf_dir, "embeddings"))
    if found is None:
        return spark.createDataFrame(
            [], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")

    def by_cluster(values: list, kind: str) -> Column:
        """One value for each cluster: an array as long as the number of centroids."""
        return F.array(*[F.lit(v) for v in values])[F.col("cluster")].cast(kind)

    k = range(len(found.centroids))
    own = [min(found.inertia.get(c, 0), LARGEST) for c in k]
    names = [F.sha2(F.lit(",".join(map(str, found.centroids[c].tolist()))), 256) for c in k]
    return found.assigned.select(
        "vec_id", "cluster", "distance", by_cluster(own, "bigint").alias("cluster_inertia"),
        F.lit(min(sum(found.inertia.values()), LARGEST)).cast("bigint").alias("inertia"),
        by_cluster(names, "string").alias("centroid_sha256"))


def _round_sql(r: int) -> str:
    return f"""
a{r} AS MATERIALIZED (
  SELECT rn, c, dist FROM (
    SELECT rn, c, dist, row_number() OVER (PARTITION BY rn ORDER BY dist, c) AS place
    FROM (SELECT e.rn, z.c, sum((e.x - z.x) * (e.x - z.x)) AS dist FROM e JOIN c{r} z USING (d) GROUP BY e.rn, z.c))
  WHERE place = 1),
m{r} AS MATERIALIZED (SELECT c, d, sum(x) AS s, count(*) AS n FROM e JOIN a{r} USING (rn) GROUP BY c, d),
c{r + 1} AS MATERIALIZED (
  SELECT z.c, z.d, CASE WHEN m.n IS NULL THEN z.x ELSE CAST((m.s - ((m.s % m.n) + m.n) % m.n) // m.n AS BIGINT) END AS x
  FROM c{r} z LEFT JOIN m{r} m ON m.c = z.c AND m.d = z.d),"""


#: three rounds and the last assignment, spelled out
OP12_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rn, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
e AS MATERIALIZED (SELECT rn, unnest(range(64)) AS d, unnest(v) AS x FROM kept),
start AS MATERIALIZED (
  SELECT rn, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS c FROM kept
  QUALIFY c < 16),
c0 AS MATERIALIZED (SELECT c, d, x FROM start JOIN e USING (rn)),{"".join(_round_sql(r) for r in range(4))}
names AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS name FROM c3 GROUP BY c)
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.dist AS BIGINT) AS distance,
  CAST(sum(a.dist) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.dist) OVER () AS BIGINT) AS inertia,
  n.name AS centroid_sha256
FROM a3 a JOIN kept k USING (rn) JOIN names n ON n.c = a.c
"""
