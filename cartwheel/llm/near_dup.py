"""MinHash near-dedup with circulant signatures and exact verification.

A document's set is that of its distinct word shingles. Documents with equal sets
form a class and go on as one. Two permutations make a class's whole signature: the
first spreads the set over the 32-bit numbers, the second, circularly shifted by k,
gives the k-th minimum. Signatures are cut into bands; classes that agree on a band
share a bucket. In each bucket the members are compared with a few centres, on their full
sets, and the links found are closed to components: a large group of copies costs a few
comparisons for each member. What the centres leave open is done exactly: classes that
buckets connect are a family; where a family spans several components, its sets are cut
into tiles of bounded bytes, by size class and hash, and each pair of tiles whose sizes
allow a link is compared in one task, all its pairs by one matrix product. So no link of
the buckets is lost, and no pair that is not a link ever becomes a row. Components are
found by rounds of minimum exchange over stored edges; nothing is gathered in one task.

The number of bands follows from the threshold: a pair at the threshold is missed with
a probability under 1e-6.

Sets are held as 64-bit shingle hashes and classes as a 64-bit digest of the set.

Defined cases: null, empty and blank texts have the empty set, are linked with nothing
and stay; rows with equal text are of one class whatever their ids; a null doc_id never
names a component that has another id; a component of null ids only has a null id;
extra columns are ignored (``deduped`` carries them through).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keyed_rows, stored, table
from .shingles import WordHasher, mix, shingle_hashes

BAND_ROWS = 5
MISS = 1e-6
#: centres a bucket may have, by its band's number: so many comparisons a member makes at most before the exact step
CENTRES = 3
#: classes whose texts are fetched by a broadcast list at most (16 bytes each)
BROADCAST_ROWS = 1_000_000
#: shingles whose minima are taken at a time
BLOCK = 2048
#: edges that a task of a round of components takes
EDGES_IN_TASK = 250_000
#: bytes of sets in a tile of a family that its centres did not connect
TILE_BYTES = 512 * 1024
#: sets, and values that they share, in one matrix product
PRODUCT_ROWS = 1024
PRODUCT_VALUES = 4096


def bands_for(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** BAND_ROWS))


def _fmix(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(13)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, length: int) -> np.ndarray:
    """Circulant minima: coordinate k is the least second permutation of (first + k) modulo 2^32."""
    first = _fmix((shingles >> np.uint64(32)).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    shifts = np.arange(length, dtype=np.uint32)
    out = np.full(length, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(first), BLOCK):
        np.minimum(out, _fmix(first[k:k + BLOCK, None] + shifts, 0x7FEB352D, 0x846CA68B).min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    rows = sig.reshape(-1, BAND_ROWS).astype(np.uint64)
    h = np.arange(len(rows), dtype=np.uint64)
    for k in range(rows.shape[1]):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + rows[:, k])
    return h.view(np.int64)


def digest(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``docs`` (doc_id, text, k, h) as (doc_id, k, h, n, c, bands): set size, class, band keys (null for the empty set)."""
    length = bands_for(percent) * BAND_ROWS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for b in batches:
            n, c, bands = [], [], []
            for text in b["text"]:
                s = np.unique(shingle_hashes(hasher.words(text), words))
                n.append(len(s))
                c.append(digest(s) if len(s) else None)
                bands.append(band_keys(signature(s, length)) if len(s) else None)
            yield pd.DataFrame({
                "k": b["k"], "no_id": b["no_id"], "h": b["h"], "n": n, "c": pd.array(c, dtype="Int64"), "bands": bands})

    out = docs.select("k", F.col("doc_id").isNull().alias("no_id"), "h", "text").mapInPandas(
        run, "k bigint, no_id boolean, h bigint, n bigint, c bigint, bands array<bigint>")
    return out.select(F.when(~F.col("no_id"), F.col("k")).alias("doc_id"), "k", "h", "n", "c", "bands")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(c, n, s): the whole sets, sorted, of the wanted classes, from one document (k, h) of each."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for b in batches:
            sets = [np.unique(shingle_hashes(hasher.words(t), words)) for t in b["text"]]
            yield pd.DataFrame({"c": b["c"], "n": [len(s) for s in sets], "s": [s.tobytes() for s in sets]})

    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, ["k", "h"])
    return stored(texts.select("c", "text").dropDuplicates(["c"]).mapInPandas(run, "c bigint, n bigint, s binary"), "op5-sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets are similar enough."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            ok = []
            for x, y in zip(p["s"], p["t"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield p.loc[ok, ["a", "b"]]

    left = sets.select(F.col("c").alias("a"), F.col("n").alias("n_a"), "s")
    right = sets.select(F.col("c").alias("b"), F.col("n").alias("n_b"), F.col("s").alias("t"))
    # the smaller set bounds the intersection, the larger one the union
    near = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    sizes = pairs.join(left.drop("s"), "a").join(right.drop("t"), "b").filter(near).select("a", "b")
    both = sizes.join(left, "a").join(right, "b").select("a", "b", "s", "t")
    return both.mapInPandas(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(c, label) of each node of ``edges`` (a, b): label is the least node of its component.

    Rounds of large-star and small-star: each node passes its least neighbour on, until
    the stored edges no longer change. A hot node's neighbours are never gathered; its
    minimum is aggregated map-side and joined back."""
    def directed(e: DataFrame) -> DataFrame:
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    # few edges need few tasks; one task's worth needs no shuffle in any round
    tasks = max(1, -(-edges.count() // EDGES_IN_TASK))
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    edges = stored(down.repartition(tasks).distinct(), "op5-edges")
    before = state(edges)
    while True:
        both = directed(edges.coalesce(tasks))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = stored(small.select("e.a", "e.b").filter("a > b").distinct(), "op5-edges")
        now = state(edges)
        if now == before:
            break
        before = now
    labels = edges.select(F.col("a").alias("c"), F.col("b").alias("label"))
    return labels.unionByName(edges.select(F.col("b").alias("c"), F.col("b").alias("label")).distinct())


def classes_and_labels(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(signatures, labels): the stored signatures of all documents, and the component (c, label) of each
    class that has a link."""
    sigs = stored(signatures(docs, words, percent), "op5-signatures")
    classes = sigs.filter("c is not null").groupBy("c").agg(
        F.first("bands").alias("bands"), F.min(F.struct("k", "h")).alias("r"))
    rows = classes.select("c", F.posexplode("bands").alias("band", "key"))
    order = F.xxhash64("c", F.col("band") % CENTRES)
    buckets = rows.groupBy("band", "key").agg(
        F.count("*").alias("members"), F.min_by("c", order).alias("centre")).filter("members > 1")
    inside = stored(rows.join(buckets, ["band", "key"]).select("band", "key", "c", "centre", "members"), "op5-buckets")
    stars = stored(inside.filter("c <> centre").select(
        F.greatest("c", "centre").alias("a"), F.least("c", "centre").alias("b")).distinct(), "op5-pairs")
    wanted = classes.join(inside.select("c").distinct(), "c", "left_semi").select(
        "c", "r.k", "r.h")
    sets = _sets(docs, stored(wanted, "op5-wanted"), words)
    links = stored(_verified(stars, sets, percent), "op5-links")
    labels = components(links)
    families = components(stars).withColumnRenamed("label", "family")
    placed = stored(families.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c")), "op5-families")
    # links across components join whole components: their labels are the nodes now
    across = components(stored(_links_across(placed, sets, percent), "op5-links")).select(F.col("label").alias("joined"), F.col("c").alias("label"))
    labels = placed.select("c", "label").join(across, "label", "left").select("c", F.coalesce("joined", "label").alias("label"))
    return sigs, stored(labels, "op5-labels")


def _incidence(sets: list[np.ndarray], shared: np.ndarray) -> np.ndarray:
    """One row for each set: which of the ``shared`` values it holds."""
    out = np.zeros((len(sets), len(shared)), np.float32)
    for k, s in enumerate(sets):
        s = s[np.searchsorted(s, shared[0]):np.searchsorted(s, shared[-1], "right")]
        at = np.searchsorted(shared, s)
        at[at == len(shared)] = 0
        out[k, at[shared[at] == s]] = 1
    return out


def similar_pairs(x: list[np.ndarray], y: list[np.ndarray], percent: int) -> np.ndarray:
    """(row of x, row of y) of all similar pairs of sorted sets. The matrices have PRODUCT_ROWS rows and
    PRODUCT_VALUES columns at most, however many sets there are and however much they share."""
    found = [np.zeros((0, 2), np.int64)]
    for i in range(0, len(x), PRODUCT_ROWS):
        for j in range(0, len(y), PRODUCT_ROWS):
            found.append(_similar_block(x[i:i + PRODUCT_ROWS], y[j:j + PRODUCT_ROWS], percent) + (i, j))
    return np.concatenate(found)


def _similar_block(x: list[np.ndarray], y: list[np.ndarray], percent: int) -> np.ndarray:
    shared = np.intersect1d(np.unique(np.concatenate(x)), np.unique(np.concatenate(y)), assume_unique=True)
    common = np.zeros((len(x), len(y)), np.int64)
    for k in range(0, len(shared), PRODUCT_VALUES):
        part = shared[k:k + PRODUCT_VALUES]
        common += np.rint(_incidence(x, part) @ _incidence(y, part).T).astype(np.int64)
    sizes = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])
    return np.argwhere((common > 0) & (100 * common >= percent * (sizes - common)))


def _links_across(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) between different components (by their labels) of one family. ``placed``: (c, family, label)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tiles in batches:
            found = []
            for x, y in zip(tiles["x"], tiles["y"], strict=True):
                if len({m["label"] for m in (*x, *y)}) < 2:
                    continue
                pairs = similar_pairs(*([np.frombuffer(m["s"], np.uint64) for m in t] for t in (x, y)), percent)
                found += {(x[i]["label"], y[j]["label"]) for i, j in pairs if x[i]["label"] != y[j]["label"]}
            yield pd.DataFrame({"a": [max(p) for p in found], "b": [min(p) for p in found]}, dtype="int64")

    # of two classes, the star has compared the only pair
    open_ = placed.groupBy("family").agg(
        F.min("label").alias("p"), F.max("label").alias("q"), F.count("*").alias("members")).filter("p <> q and members > 2")
    # similar sets are of one size class or of neighbouring ones
    step = math.log(100 / percent) * 1.0001
    inside = placed.join(open_.select("family"), "family").join(sets.select("c", "n"), "c").withColumn(
        "size_class", F.floor(F.log("n") / step).cast("int"))
    tiles_of = inside.groupBy("family", "size_class").agg(F.ceil(F.sum("n") * 8 / TILE_BYTES).alias("tiles"))
    dealt = inside.join(tiles_of, ["family", "size_class"]).select(
        "family", "size_class", F.pmod(F.xxhash64("c"), F.col("tiles")).alias("tile"), "c", "label")
    tiles = stored(dealt.join(sets.select("c", "s"), "c").groupBy("family", "size_class", "tile").agg(
        F.collect_list(F.struct("c", "label", "s")).alias("x")), "op5-tiles")
    mine = tiles.withColumn("other_class", F.explode(F.array("size_class", F.col("size_class") + 1)))
    theirs = tiles.select("family", F.col("size_class").alias("other_class"), F.col("tile").alias("other"), F.col("x").alias("y"))
    once = (F.col("size_class") < F.col("other_class")) | (F.col("tile") <= F.col("other"))
    pairs = mine.join(theirs, ["family", "other_class"]).filter(once).select("x", "y")
    return pairs.mapInPandas(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept, k, h, label (the component itself, null
    for the empty set). ``docs``: (doc_id, text, k, h)."""
    sigs, labels = classes_and_labels(docs, words, percent)
    per_class = sigs.filter("c is not null").groupBy("c").agg(F.min("doc_id").alias("least")).join(labels, "c", "left")
    per_class = per_class.withColumn("label", F.coalesce("label", "c"))
    groups = per_class.groupBy("label").agg(F.min("least").alias("component_id"))
    found = per_class.join(groups, "label").select("c", "label", "component_id")
    out = sigs.drop("bands").join(found, "c", "left").withColumn(
        "component_id", F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "k", "h", "label")


def deduped(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of ``docs``, that with the least id (of equal ids, the least row
    hash), all columns carried; documents without words stay."""
    found = near_duplicates(documents(docs), words, percent).filter("kept")
    alone = F.when(F.col("label").isNull(), F.struct("k", "h"))
    chosen = found.groupBy("label", alone.alias("alone")).agg(F.min(F.struct("k", "h")).alias("r"))
    rows, _, columns = keyed_rows(docs)
    kept = rows.join(chosen.select("r.k", "r.h"), ["k", "h"], "left_semi")
    return kept.dropDuplicates(["k", "h"]).select(*columns).toDF(*docs.columns)


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(table(spark, sf_dir, "documents")), words=3, percent=85).drop("k", "h", "label")
