"""Benchmark decontamination: a distributed positional inverted index.

Texts become words: A-Z lower-cased, then runs of digits, ASCII letters and
characters over U+007F. An item's windows are its runs of ten consecutive words
(one window, the whole item, where it has fewer). The index stores, clustered by
term, the postings (document, position) of the training tokens that searches
start from: the rarest terms of each window, by their counts over the whole
corpus. A window's occurrences are the intersection of its rare terms' lists,
each adjusted by the term's offset, confirmed word by word on the full text.
Proximity matches let the adjusted positions differ by up to ``slop`` words from the
rarest term's: all words of the window must stand there, each at a place of its own.
op8_decontaminate reports the exact occurrences, op8_proximity the proximity matches
(exact ones among them).

The test side is broadcast only if its counted size is under a bound; beyond it
the same joins run as shuffled joins, where hot terms are split by Spark's skew
handling. Postings of hot terms are split over several partitions when stored.

Defined cases: null and empty texts have no words and are never hit; an item
without words has no window; items with a null id hit words but are not listed;
repeated items count once; rows equal in doc_id and text are one document with
the same result each; extra columns are ignored (``clean`` carries them through).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, documents, keyed_rows, stored, table, take

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
#: lists intersected before the full text is looked at
RARE_TERMS = 3
#: words by which a proximity match's positions may differ
NEAR_SLOP = 2
#: bytes of the test side up to which it is broadcast
BROADCAST_BYTES = 64 * 1024 * 1024


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD, -1), "")


def _sized(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


@dataclass
class Index:
    """``windows``: (wid, w, rare: array of (n, off, term)); ``items``: (wid, item_id);
    ``postings``: (term, k, h, pos), stored by term; ``n_windows``: row count of windows;
    ``docs``: the indexed (doc_id, text, k, h)."""

    windows: DataFrame
    items: DataFrame
    postings: DataFrame
    n_windows: int
    docs: DataFrame


def item_windows(items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(item_id, w): each window of each item."""
    n = F.size("ws")
    starts = F.when(n <= size, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), n - size + 1))
    return (
        take(items, item_id="bigint", text="string").select("item_id", words(F.col("text")).alias("ws")).filter(n > 0)
        .select("item_id", F.explode(F.transform(starts, lambda i: F.slice("ws", i, size))).alias("w")).distinct())


def build_index(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS, rare: int = RARE_TERMS) -> Index:
    """``docs``: (doc_id, text, k, h) as from ``documents``."""
    found = stored(item_windows(items, size).withColumn("wid", F.xxhash64("w")), "op8-windows")
    terms = stored(found.select(F.explode("w").alias("term")).distinct(), "op8-terms")
    n_windows, n_terms = found.count(), terms.count()
    tokens = docs.select(F.explode(words(F.col("text"))).alias("term"))
    counts = stored(
        tokens.join(_sized(terms, n_terms, 100), "term").groupBy("term").agg(F.count("*").alias("n")), "op8-counts")
    ranked = (
        found.select("wid", "w").distinct().select("wid", "w", F.posexplode("w").alias("off", "term"))
        .join(_sized(counts, n_terms, 100), "term", "left")
        .groupBy("wid", "w").agg(
            F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term"))).alias("all")))
    # a window with a term that no document has cannot occur
    windows = stored(
        ranked.filter(F.get("all", 0)["n"] > 0).select("wid", "w", F.slice("all", 1, rare).alias("rare")), "op8-rare")
    starts = windows.select(F.explode("rare").alias("r")).select("r.term").distinct()
    postings = (
        docs.select("k", "h", F.posexplode(words(F.col("text"))).alias("pos", "term"))
        .join(_sized(starts, n_terms, 100), "term")
        .select("term", "k", "h", "pos")
        .hint("rebalance", "term").sortWithinPartitions("term", "k", "pos"))
    return Index(windows, found.select("wid", "item_id"), stored(postings, "op8-postings"), n_windows, docs)


def _list(index: Index, k: int) -> DataFrame:
    """(wid, term, off) of each window's k-th rarest term."""
    r = F.get("rare", k)
    rows = index.windows.select("wid", r["term"].alias("term"), r["off"].alias("off")).filter("term is not null")
    return _sized(rows, index.n_windows, 120)


def candidates(index: Index, rare: int = RARE_TERMS, slop: int = 0) -> DataFrame:
    """(wid, k, h, start): where all rare terms of a window stand at its offsets, the
    others than the rarest up to ``slop`` words off."""
    out = (
        index.postings.join(_list(index, 0), "term")
        .select("wid", "k", "h", (F.col("pos") - F.col("off")).alias("start")).filter(F.col("start") >= -slop))
    for k in range(1, rare):
        term, off = f"term{k}", f"off{k}"
        next_term = _list(index, k).select("wid", F.col("term").alias(term), F.col("off").alias(off))
        out = out.join(next_term, "wid", "left")
        held = index.postings.select(
            F.col("term").alias("p_term"), F.col("k").alias("p_k"), F.col("h").alias("p_h"), "pos").distinct()
        # windows of fewer words than lists have no k-th term and pass
        short, full = out.filter(F.col(term).isNull()), out.filter(F.col(term).isNotNull())
        at = F.col("start") + F.col(off)
        full = full.withColumn("at", F.explode(F.sequence(at - slop, at + slop)) if slop else at)
        full = full.join(
            held, (F.col(term) == F.col("p_term")) & (F.col("h") == F.col("p_h"))
            & (F.col("k") == F.col("p_k")) & (F.col("at") == F.col("pos")), "left_semi")
        cols = ["wid", "k", "h", "start"]
        out = full.select(*cols).unionByName(short.select(*cols))
    return out.distinct()


def phrase_matches(docs: DataFrame, index: Index) -> DataFrame:
    """Per row: doc_id, k, h, n_words and ``hits``, the sorted (start, length, wid) of every
    exact occurrence of a window; stored. ``docs``: (doc_id, text, k, h)."""
    found = candidates(index).join(_sized(index.windows.select("wid", "w"), index.n_windows, 400), "wid")
    per_doc = found.groupBy("k", "h").agg(F.collect_list(F.struct("start", "wid", "w")).alias("found"))
    both = docs.join(per_doc, ["k", "h"], "left")
    ws = words(F.col("text"))
    real = F.filter("found", lambda c: F.slice("ws", c["start"] + 1, F.size(c["w"])) == c["w"])
    hits = F.transform(real, lambda c: F.struct(
        c["start"].alias("start"), F.size(c["w"]).alias("length"), c["wid"].alias("wid")))
    return stored(
        both.select("doc_id", "k", "h", F.coalesce(ws, F.array().cast("array<string>")).alias("ws"), "found").select(
            "doc_id", "k", "h", F.size("ws").alias("n_words"),
            F.when(F.col("found").isNotNull(), F.sort_array(hits)).alias("hits")), "op8-hits")


def near_hits(index: Index, slop: int) -> DataFrame:
    """Per row of the index's documents: doc_id, k, h, n_words and ``hits``, the (start, wid, at) of
    every proximity match; ``at`` are the positions of the window's words. Stored."""
    found = candidates(index, slop=slop).join(_sized(index.windows.select("wid", "w"), index.n_windows, 400), "wid")
    per_doc = found.groupBy("k", "h").agg(F.collect_list(F.struct("start", "wid", "w")).alias("found"))

    def places(c: Column) -> Column:
        # the first free place for each word in turn: repeats of a word have equally long
        # ranges in order, so this finds places for all where there are any
        def place(used: Column, j: Column) -> Column:
            free = F.filter(
                F.sequence(c["start"] + j - slop, c["start"] + j + slop),
                lambda p: (F.get("ws", p) == F.get(c["w"], j)) & ~F.array_contains(used, p))
            return F.concat(used, F.slice(free, 1, 1))

        return F.aggregate(F.sequence(F.lit(0), F.size(c["w"]) - 1), F.array().cast("array<int>"), place)

    placed = F.transform("found", lambda c: F.struct(
        c["start"].alias("start"), c["wid"].alias("wid"), places(c).alias("at"), F.size(c["w"]).alias("n")))
    hits = F.transform(F.filter("placed", lambda c: F.size(c["at"]) == c["n"]), lambda c: F.struct(
        c["start"].alias("start"), c["wid"].alias("wid"), c["at"].alias("at")))
    ws = F.coalesce(words(F.col("text")), F.array().cast("array<string>"))
    return stored(
        index.docs.join(per_doc, ["k", "h"], "left").select("doc_id", "k", "h", ws.alias("ws"), "found")
        .select("doc_id", "k", "h", F.size("ws").alias("n_words"), F.when(F.col("found").isNotNull(), placed).alias("placed"))
        .select("doc_id", "k", "h", "n_words", F.when(F.col("placed").isNotNull(), hits).alias("hits")), "op8-near")


def proximity_matches(index: Index, slop: int) -> DataFrame:
    """(wid, k, h, start): all words of a window stand in the document with their
    offset-adjusted positions within ``slop`` of that of the rarest one."""
    hit = F.explode("hits").alias("c")
    return near_hits(index, slop).select("k", "h", hit).select("c.wid", "k", "h", "c.start").distinct()


def _covered(hits: Column) -> Column:
    """Words inside at least one of the sorted hits."""
    end = lambda c: c["start"] + c["length"]
    zero = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("n"))
    return F.aggregate(hits, zero, lambda a, c: F.struct(
        F.greatest(a["reach"], end(c)).alias("reach"),
        (a["n"] + F.greatest(end(c) - F.greatest(c["start"], a["reach"]), F.lit(0))).alias("n")))["n"]


def _listed(hits: DataFrame, index: Index) -> DataFrame:
    """(k, h, items): the sorted ids, as text, of the items that a document's hits belong to."""
    return (
        hits.filter(F.size("hits") > 0)
        .select("k", "h", F.explode(F.array_distinct(F.col("hits.wid"))).alias("wid")).distinct()
        .join(_sized(index.items.filter("item_id is not null"), index.n_windows, 60), "wid")
        .groupBy("k", "h").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items (sorted ids as text), contaminated."""
    docs = documents(docs)
    index = build_index(docs, items, size)
    hits = phrase_matches(docs, index)
    n_hit = F.when(F.col("hits").isNull(), 0).otherwise(_covered(F.col("hits")))
    both = hits.join(_listed(hits, index), ["k", "h"], "left")
    return both.select(
        "doc_id", F.col("n_words").cast("bigint"), n_hit.cast("bigint").alias("n_hit"),
        F.size(F.coalesce("items", F.array().cast("array<string>"))).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"), "k", "h")


def proximity(docs: DataFrame, items: DataFrame, slop: int = NEAR_SLOP, size: int = WINDOW_WORDS) -> DataFrame:
    """Per row: doc_id, n_words, n_near (words in proximity matches), n_near_items, near_items (sorted ids as text), near."""
    index = build_index(documents(docs), items, size)
    hits = near_hits(index, slop)
    n_near = F.when(F.col("hits").isNull(), 0).otherwise(F.size(F.array_distinct(F.flatten(F.col("hits.at")))))
    near_items = F.coalesce("items", F.array().cast("array<string>"))
    return hits.join(_listed(hits, index), ["k", "h"], "left").select(
        "doc_id", F.col("n_words").cast("bigint"), n_near.cast("bigint").alias("n_near"),
        F.size(near_items).cast("bigint").alias("n_near_items"), near_items.alias("near_items"), (n_near > 0).alias("near"))


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` without the contaminated documents, all columns carried."""
    rows, _, columns = keyed_rows(docs)
    bad = contamination(docs, items, size).filter("contaminated").select("k", "h").distinct()
    return rows.join(bad, ["k", "h"], "left_anti").select(*columns).toDF(*docs.columns)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op8_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = proximity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_near", "n_near_items",
        F.sha2(F.array_join("near_items", ","), 256).alias("near_items_sha256"), "near")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS ws
  FROM documents),
i AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS ws
  FROM benchmark),
w AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(ws, s, s + 9), ' ') AS k, least(len(ws), 10) AS n
  FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS s FROM i WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM w),
o AS (
  SELECT doc_id, s, n, array_to_string(list_slice(ws, s, s + n - 1), ' ') AS k
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS s FROM d, lens)),
hit AS (SELECT DISTINCT doc_id, s, n, item_id FROM o JOIN w USING (k, n)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
