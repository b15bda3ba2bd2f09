"""Line dedup: repeated windows of three consecutive lines.

A document's lines are split at ``\\n``; lines that are blank after trimming
spaces, tabs and carriage returns take no part in windows. Every three
consecutive remaining lines (trimmed) form a window, hashed to 128 bits. Over
all documents, the first occurrence of a window, by (doc_id, position), stays;
each later one, in another document or further down in the same one, covers its
lines and the blank ones between. Covered positions are merged into spans, also
where they only touch, and removed. Occurrences are judged on the input, so they may overlap.

Defined cases: null and empty texts, and texts of fewer than three such lines,
have no window and stay as they are; a null doc_id comes after all others; rows
equal in doc_id and text are one document and get the same result each; extra
columns are ignored (``deduped`` carries them through).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, keyed_rows, table

LINES_IN_WINDOW = 3
BLANK = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, size: int = LINES_IN_WINDOW) -> DataFrame:
    """(doc_id, k, h, first, last, a, b): line numbers of each window and its 128-bit key."""
    numbered = F.transform(_lines(F.col("text")), lambda x, i: F.struct(i.alias("i"), F.trim(x, F.lit(BLANK)).alias("s")))
    full = F.filter(numbered, lambda x: x["s"] != "")

    def window(x: Column, k: Column) -> Column:
        parts = [F.get("full", k + j)["s"] for j in range(size)]
        return F.struct(
            x["i"].alias("first"), F.get("full", k + size - 1)["i"].alias("last"),
            F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(size), *parts[::-1]).alias("b"))

    some = docs.select("doc_id", "k", "h", full.alias("full")).filter(F.size("full") >= size)
    starts = F.transform(F.expr(f"slice(full, 1, size(full) - {size - 1})"), window)
    return some.select("doc_id", "k", "h", F.inline(starts))


def repeated_spans(docs: DataFrame, size: int = LINES_IN_WINDOW) -> DataFrame:
    """(k, h, spans): the merged line spans that later occurrences cover."""
    found = windows(docs, size)
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("h"), F.col("first"))
    firsts = found.groupBy("a", "b").agg(F.min(place).alias("kept"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = (
        found.join(firsts, ["a", "b"]).filter(place != F.col("kept"))
        .select("k", "h", "first", "last").distinct())
    order = Window.partitionBy("k", "h").orderBy("first")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.coalesce(F.col("first") > reach + 1, F.lit(True)).cast("int")
    merged = (
        later.withColumn("new", opened)
        .withColumn("span", F.sum("new").over(order))
        .groupBy("k", "h", "span").agg(F.min("first").alias("first"), F.max("last").alias("last")))
    return merged.groupBy("k", "h").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))


def _kept(lines: Column, spans: Column) -> Column:
    """The lines outside the sorted, disjoint spans: the slices between them."""
    gaps = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda k: F.slice(
        lines,
        F.when(k == 0, F.lit(1)).otherwise(F.get(spans, k - 1)["last"] + 2),
        F.when(k < F.size(spans), F.get(spans, k)["first"]).otherwise(F.size(lines))
        - F.when(k == 0, F.lit(0)).otherwise(F.get(spans, k - 1)["last"] + 1)))
    return F.flatten(gaps)


def _applied(docs: DataFrame, size: int) -> DataFrame:
    """``docs`` (doc_id, text, k, h, ...) with n_lines, n_removed, n_spans and the text that stays."""
    spans = repeated_spans(docs.select("doc_id", "text", "k", "h"), size)
    lines = _lines(F.col("text"))
    hit = F.col("spans").isNotNull()
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["last"] - s["first"] + 1)
    return docs.join(spans, ["k", "h"], "left").withColumns({
        "n_lines": F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, 0).otherwise(F.size(lines)),
        "n_removed": F.when(hit, removed).otherwise(0),
        "n_spans": F.when(hit, F.size("spans")).otherwise(0),
        "kept": F.when(hit, F.array_join(_kept(lines, F.col("spans")), "\n")).otherwise(F.col("text"))})


def dedup_lines(docs: DataFrame, size: int = LINES_IN_WINDOW) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, n_spans, text (what stays)."""
    return _applied(documents(docs), size).select("doc_id", "n_lines", "n_removed", "n_spans", F.col("kept").alias("text"))


def deduped(docs: DataFrame, size: int = LINES_IN_WINDOW) -> DataFrame:
    """``docs`` with repeated windows taken out of the text (n_chars follows, where
    there is such a column) and all columns carried. A document that loses all of its
    non-blank lines has nothing left to train on and goes; others stay."""
    keyed, where, columns = keyed_rows(docs)
    done = _applied(keyed, size).filter((F.col("n_removed") == 0) | (F.trim("kept", F.lit(BLANK + "\n")) != ""))
    new = {where["text"]: F.col("kept")}
    if "n_chars" in where:
        new[where["n_chars"]] = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col(where["n_chars"]))
    return done.select(*[new.get(c, F.col(c)).alias(c) for c in columns]).toDF(*docs.columns)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents),
f AS (SELECT doc_id, i, trim(raw, ' ' || chr(9) || chr(13)) AS s FROM l WHERE trim(raw, ' ' || chr(9) || chr(13)) <> ''),
w AS (
  SELECT doc_id, i AS a, lead(i, 2) OVER o AS b, [s, lead(s, 1) OVER o, lead(s, 2) OVER o] AS k
  FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, a, b, row_number() OVER (PARTITION BY k ORDER BY doc_id, a) AS nth FROM w WHERE b IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(a, b)) AS i FROM r WHERE nth > 1),
m AS (SELECT l.doc_id, l.i, l.raw, gone.i IS NOT NULL AS cut FROM l LEFT JOIN gone USING (doc_id, i)),
e AS (SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM m),
c AS (
  SELECT doc_id, count(*)::INTEGER AS n_lines, count(*) FILTER (cut)::INTEGER AS n_removed,
         count(*) FILTER (opens)::INTEGER AS n_spans,
         coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT cut), '') AS text
  FROM e GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN coalesce(length(d.text), 0) = 0 THEN 0 ELSE n_lines END AS n_lines,
       coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       CASE WHEN d.text IS NULL THEN NULL ELSE c.text END AS text
FROM documents d LEFT JOIN c USING (doc_id)
"""
