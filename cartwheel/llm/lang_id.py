"""Language ID by compression: the language whose dictionary encodes a text shortest.

For each language a raw-content zstandard dictionary is cut from a bounded sample
of labelled lines. A text, reduced to its lower-cased words and cut into blocks of
1500 bytes, is compressed block by block with every dictionary; the language with the
fewest bytes in all is chosen. When the second best needs hardly more bytes, the
margin is narrow and the operator rejects the document.

The fit takes, per language, SAMPLE_LINES lines, one at most from a document, each
distinct one once and up to LINE_CHARS characters; of all lines, those with the smallest
hashes. A document without a line of LEAST_LINE_CHARS characters gives its text, lines
joined, from its first letter on, so every language with letters is learned. The sample is all that reaches the driver; it does not grow
with the input. Every document is classified over its whole text.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
rejected; a null doc_id is never learned from and counts as held out; ties between
languages go to the first in alphabetical order and are rejected; with no labelled
line at all every text is ``und``; repeated rows each get their row; extra columns
are ignored (``identified`` carries them through).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_position, may_be_first, stored, table, take

SAMPLE_LINES = 1000
LINE_CHARS = 300
LEAST_LINE_CHARS = 40
LEVEL = 6
BLOCK_BYTES = 1500
#: share of the second best size by which the best must be smaller
MARGIN = 0.005
#: bytes of difference that make one language e times as likely (for the score)
SCALE_BYTES = 6.0
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def reduced(text: str) -> bytes:
    # number signs such as fractions and Roman numerals are word characters, but no letters
    words = (w if w.isalpha() else "".join(filter(str.isalpha, w)) for w in WORD.findall(text.lower()))
    return " ".join(filter(None, words)).encode("utf-8", "replace")


def sample(docs: DataFrame, lines: int = SAMPLE_LINES) -> dict[str, list[str]]:
    """The bounded training sample: language -> lines, on the driver."""
    rows = take(docs, doc_id="bigint", text="string", lang="string")
    rows = rows.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    long = F.filter(F.split("text", "\n", -1), lambda x: (F.length(x) >= LEAST_LINE_CHARS) & x.rlike(r"\p{L}"))
    picked = F.get("ls", F.pmod(F.xxhash64("doc_id"), F.size("ls")).cast("int"))
    whole = F.regexp_extract("text", r"(?s)\p{L}.*", 0)
    once = (
        rows.select("lang", "doc_id", "text", long.alias("ls"))
        .select("lang", F.left(F.when(F.size("ls") > 0, picked).otherwise(whole), F.lit(LINE_CHARS)).alias("line"))
        .filter("line <> ''").distinct())
    # a line a document at most, stored: its counts give the cut, so few rows are ranked
    once = stored(once, "op3-lines")
    # one row a language, as the dictionaries that the driver holds
    counts = F.broadcast(once.groupBy("lang").agg(F.count("*").alias("of")))
    few = once.join(counts, "lang").filter(may_be_first(F.xxhash64("line"), lines, F.col("of")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("line"), "line")
    kept = few.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= lines)
    out: dict[str, list[str]] = {}
    for lang, line in kept.select("lang", "line").orderBy("lang", "nth").collect():
        out.setdefault(lang, []).append(line)
    return out


def dictionaries(lines: dict[str, list[str]]) -> dict[str, bytes]:
    contents = {lang: reduced("\n".join(ls)) for lang, ls in sorted(lines.items())}
    # zstandard takes no fewer than 8 bytes: what is shorter is repeated
    return {lang: c if len(c) >= 8 else b" ".join([c] * 8) for lang, c in contents.items() if c}


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)


def classify(text: str | None, compressors: dict[str, zstandard.ZstdCompressor]) -> tuple[str, float, float]:
    """(language, score, margin) of one text."""
    data = reduced(text) if text else b""
    if not data or not compressors:
        return UNKNOWN, 0.0, 0.0
    blocks = [data[k:k + BLOCK_BYTES] for k in range(0, len(data), BLOCK_BYTES)]
    sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in compressors.items())
    best, lang = sizes[0]
    if len(sizes) == 1:
        return lang, 1.0, 1.0
    total = sum(2.718281828459045 ** (-min(s - best, 4000) / SCALE_BYTES) for s, _ in sizes)
    return lang, 1.0 / total, (sizes[1][0] - best) / sizes[1][0]


def _classified(rows: DataFrame, text: str, contents: dict[str, bytes]) -> DataFrame:
    """``rows`` with lang_pred, score and margin of column ``text``; the others pass untouched."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = {lang: _compressor(c) for lang, c in contents.items()}
        for b in batches:
            found = [classify(t, compressors) for t in b.column(text).to_pylist()]
            lang, score, margin = (pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.float64())))
            yield pa.RecordBatch.from_arrays([*b.columns, lang, score, margin], [*b.schema.names, "lang_pred", "score", "margin"])

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("margin", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, margin, rejected."""
    contents = dictionaries(sample(docs))
    done = _classified(take(docs, doc_id="bigint", text="string"), "text", contents)
    return done.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin",
        ((F.col("lang_pred") == UNKNOWN) | (F.col("margin") < margin)).alias("rejected"))


def identified(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """``docs`` without the documents that the operator rejects, all columns carried."""
    contents = dictionaries(sample(docs))
    plain, where = by_position(docs)
    done = _classified(plain, where["text"], contents)
    return done.filter((F.col("lang_pred") != UNKNOWN) & (F.col("margin") >= margin)).select(*plain.columns).toDF(*docs.columns)


def op3_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
