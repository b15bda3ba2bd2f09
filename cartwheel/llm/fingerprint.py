"""Document fingerprints: 128-bit SimHash over word shingles.

The terms of a text are its runs of five consecutive words (lower-cased, split
at white space; the whole sequence where it has fewer). Each occurrence votes +1
or -1 on every bit with the bits of the term's hash, so a term weighs as often
as it occurs; the signs of the sums are the fingerprint. Likeness is the share
of equal bits. For a Hamming radius r, the bits are cut into r + 2 blocks:
fingerprints within r agree on at least two blocks, so a table for each pair of
blocks, keyed by them (the permuted prefix), holds every match together.

Defined cases: null and empty texts, and texts without words, have the all-zero
fingerprint; a tied vote gives 0; rows equal in doc_id and text are one document
with the same result each; a null doc_id comes first in descending order's end
(after all ids); of one document alone the next one is itself; extra columns are
ignored. A fingerprint shared by many documents is one entry of the tables, with
its number of documents.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, stored, table

SHINGLE_WORDS = 5
BITS = 128
RADIUS = 6
#: every document whose id this divides is a query of the registered search
QUERY_STEP = 100


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``texts``: unique ``keys`` and ``text``. Returns keys, hi, lo (the two halves).

    Two 32-bit counters of set bits share each of 64 sums, so one pass of map-side
    aggregation over the terms counts the votes of all 128 bits."""
    ws = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+", -1), "")
    n = F.size("ws")
    starts = F.when(n == 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(1), F.greatest(n - SHINGLE_WORDS + 1, F.lit(1))))
    terms = (
        texts.select(*keys, ws.alias("ws"))
        .select(*keys, F.explode_outer(F.transform(starts, lambda i: F.xxhash64(F.slice("ws", i, SHINGLE_WORDS)))).alias("a"))
        .withColumn("b", F.when(F.col("a").isNotNull(), F.xxhash64("a"))))
    pair = F.lit((1 << 32) | 1)
    sums = [F.sum(F.shiftrightunsigned(c, i).bitwiseAND(pair)).alias(f"{c}{i}") for c in "ab" for i in range(32)]
    votes = terms.groupBy(*keys).agg(F.count("a").alias("n"), *sums)

    def half(c: str) -> Column:
        out = F.lit(0).cast("bigint")
        for i in range(32):
            for ones, bit in ((F.col(f"{c}{i}").bitwiseAND(F.lit((1 << 32) - 1)), i),
                              (F.shiftrightunsigned(F.col(f"{c}{i}"), 32), i + 32)):
                value = (1 << bit) - (1 << 64 if bit == 63 else 0)
                out = out.bitwiseOR(F.when(ones * 2 > F.col("n"), F.lit(value).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        return out

    return votes.select(*keys, half("a").alias("hi"), half("b").alias("lo"))


def distance(hi: Column, lo: Column, other_hi: Column, other_lo: Column) -> Column:
    return F.bit_count(hi.bitwiseXOR(other_hi)) + F.bit_count(lo.bitwiseXOR(other_lo))


def likeness(d: Column) -> Column:
    return 1 - d / BITS


def as_text(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def _block_tables(prints: DataFrame, radius: int) -> DataFrame:
    """``prints`` (hi, lo, ...) once for each pair of the radius + 2 blocks: adds t (table) and key."""
    blocks, bits = radius + 2, BITS // (radius + 2)

    def block(k: int) -> Column:
        lo, hi = k * bits, BITS if k == blocks - 1 else (k + 1) * bits
        parts = []
        for col, base in (("lo", 0), ("hi", 64)):
            a, b = max(lo, base), min(hi, base + 64)
            if a < b:
                mask = (1 << (b - a)) - 1
                parts.append(F.shiftrightunsigned(F.col(col), a - base).bitwiseAND(F.lit(mask - (1 << 64 if mask >> 63 else 0))))
        return F.xxhash64(*parts) if len(parts) > 1 else parts[0]

    rows = [F.struct(F.lit(t).alias("t"), F.xxhash64(block(i), block(j)).alias("key"))
            for t, (i, j) in enumerate(combinations(range(blocks), 2))]
    return prints.select("*", F.inline(F.array(*rows)))


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All (q_hi, q_lo, hi, lo) of distinct ``queries`` and distinct ``prints`` (hi, lo)
    within the radius. Each pair is made once, by its first common table."""
    q = _block_tables(queries.select("hi", "lo"), radius).withColumnsRenamed({"hi": "q_hi", "lo": "q_lo"})
    p = _block_tables(prints.select("hi", "lo"), radius)
    near = distance(F.col("q_hi"), F.col("q_lo"), F.col("hi"), F.col("lo")) <= radius
    return q.join(p, ["t", "key"]).filter(near).select("q_hi", "q_lo", "hi", "lo").distinct()


def successors(docs: DataFrame) -> DataFrame:
    """(k, h, n_chars, next_k, next_h): each document's next one by descending (doc_id, h),
    after the last the first. The order is cut into ranges, stored with their number;
    only one row for each range meets the others."""
    ids = docs.select("doc_id", "k", "h", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars")).distinct()
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc()]
    ranges = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = stored(ids.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "op4-ids")
    inside = Window.partitionBy("part").orderBy(*order)
    me = F.struct("k", "h")
    chained = ids.withColumns({"next": F.lead(me).over(inside), "nth": F.row_number().over(inside)})
    heads = chained.filter("nth = 1").select("part", me.alias("head"))
    # one row for each range
    whole = Window.partitionBy(F.lit(0)).orderBy("part")
    following = heads.select(
        "part", F.coalesce(F.lead("head").over(whole), F.first("head").over(whole)).alias("after"))
    both = chained.join(following, "part").withColumn("next", F.coalesce("next", "after"))
    return stored(both.select(
        "k", "h", "n_chars", F.col("next.k").alias("next_k"), F.col("next.h").alias("next_h")), "op4-next")


def edited_texts(docs: DataFrame, chain: DataFrame) -> DataFrame:
    """(k, h, text, edited) of each row: the last third of the text replaced by as many
    first characters of the next document's. Only those leave it, and all joins and the
    aggregation that follows are on (k, h): the texts themselves are shuffled once."""
    texts = docs.select("k", "h", F.coalesce("text", F.lit("")).alias("text"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    wanted = chain.select(
        F.col("next_k").alias("k"), F.col("next_h").alias("h"),
        F.col("k").alias("for_k"), F.col("h").alias("for_h"), third.alias("need"))
    heads = texts.join(wanted, ["k", "h"]).select(
        F.col("for_k").alias("k"), F.col("for_h").alias("h"), F.left("text", F.col("need")).alias("tail"))
    both = texts.join(chain.select("k", "h", "n_chars"), ["k", "h"]).join(heads.dropDuplicates(["k", "h"]), ["k", "h"])
    keep = F.left("text", F.col("n_chars") - third)
    return both.select("k", "h", "text", F.concat(keep, F.col("tail")).alias("edited"))


def fingerprint_report(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per row: fingerprints of its text and of its edited text, their likeness and that
    to the next document's; and n_near, for documents whose id QUERY_STEP divides: how many
    other rows' fingerprints lie within the radius (null for the rest)."""
    docs = documents(docs)
    chain = successors(docs)
    both = edited_texts(docs, chain).select("k", "h", F.sha2("edited", 256).alias("edited_sha256"), F.inline(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))))
    pick = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    # repeated rows of a document only scale its votes
    prints = fingerprints(both, ["k", "h", "edited_sha256", "kind"]).groupBy("k", "h", "edited_sha256").agg(
        pick(0, "hi").alias("hi"), pick(0, "lo").alias("lo"), pick(1, "hi").alias("e_hi"), pick(1, "lo").alias("e_lo"))
    prints = stored(prints, "op4-prints")
    rows = docs.select("doc_id", "k", "h").join(prints, ["k", "h"]).join(chain, ["k", "h"])
    after = prints.select(F.col("k").alias("next_k"), F.col("h").alias("next_h"), F.col("hi").alias("a_hi"), F.col("lo").alias("a_lo"))
    classes = rows.groupBy("hi", "lo").agg(F.count("*").alias("copies"))
    asked = rows.filter(F.col("doc_id") % QUERY_STEP == 0).select("hi", "lo").distinct()
    near = (
        within_radius(asked, classes, radius).join(classes, ["hi", "lo"])
        .groupBy(F.col("q_hi").alias("hi"), F.col("q_lo").alias("lo")).agg((F.sum("copies") - 1).alias("n_near")))
    hi, lo = F.col("hi"), F.col("lo")
    return rows.join(after, ["next_k", "next_h"]).join(near, ["hi", "lo"], "left").select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), "edited_sha256",
        as_text(hi, lo).alias("fingerprint"), as_text(F.col("e_hi"), F.col("e_lo")).alias("edited_fingerprint"),
        likeness(distance(hi, lo, F.col("e_hi"), F.col("e_lo"))).alias("near_edited"),
        likeness(distance(hi, lo, F.col("a_hi"), F.col("a_lo"))).alias("near_next"),
        F.when(F.col("doc_id") % QUERY_STEP == 0, F.col("n_near")).alias("n_near"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(table(spark, sf_dir, "documents"))
