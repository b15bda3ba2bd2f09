"""Phrase collocations by multikey quicksort of routed suffixes.

Every word position starts a suffix: the up to ``LONGEST`` words that follow in its
piece. Suffixes are routed to parts by a hash of their two leading words, so that a part
holds every suffix of a phrase of two words or more. A part's suffixes are ordered by a
three-way multikey quicksort on word numbers, as deep as the longest phrase: rows equal to
the pivot go on with their next word, and how many they are is a phrase's count; any
partition with fewer rows than the least count is abandoned unsorted.

Suffixes travel as blocks, one row for each part and some million positions: columns of
word numbers and the words they stand for, compressed. No dictionary of the corpus is
needed anywhere. A part over its size (a hot pair of words) is routed again by three
words, then four, then five, with equal suffixes collapsed to one weighted row in each
block; counts of the shorter phrase are summed by Spark from one row for each block. So a
part is bounded whatever one word, pair or passage holds. Word counts come from the same
pass and are summed by Spark.

Scores are whole numbers in 38-digit decimals. A phrase lies inside a longer one of equal
count only if it lies inside one that is a single word longer, since the counts between
are equal too; so only the two phrases one word shorter are looked up.

Defined cases: null and empty texts have no words; a null lang is ``und`` (together with
texts whose lang is that string); other columns are ignored; rows that repeat count each;
long texts are read some megabytes at a time, phrases running on; ties end with the
phrase in byte order; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table, take
from .shingles import mix

#: words of the longest phrase
LONGEST = 5
#: occurrences a phrase needs
LEAST = 100
#: phrases returned of each language
TOP = 2000
#: bytes of text whose suffixes a part holds on the average
PART_BYTES = 12 << 20
#: suffixes of a part that are sorted without routing them again
PART_ROWS = 4_000_000
#: positions that are routed at a time in a task (some 30 bytes each), and distinct words held until then
FLUSH = 6_000_000
FLUSH_WORDS = 1_000_000
#: positions whose part is computed at a time
STEP = 1 << 19
#: bytes of a text that are read at a time
PIECE_BYTES = 4 << 20
#: groups that a language's phrases are ranked in before the last ranking
RANK_GROUPS = 64
#: the part of word counts
WORDS = -1
BLOCKS = "part bigint, depth int, lang string, n int, words binary, data binary"
COUNTS = "lang string, phrase string, len int, f bigint"

_BOUNDARY = re.compile(rb"[ \t.,;:!?\n-\r]")
#: lower-cases A-Z; a tab is a space, a piece ends at a dot
_PLAIN = bytes(46 if c in b",;:!?\n\v\f\r" else 32 if c == 9 else c for c in bytes(range(256)).lower())


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, ``.`` where a piece ends, some at a time."""
    at = 0
    while at < len(data):
        end = at + PIECE_BYTES
        if end < len(data):
            found = _BOUNDARY.search(data, end)
            end = found.start() if found else len(data)
        yield data[at:end].translate(_PLAIN).replace(b".", b" . ").split()
        at = end


class _Numbers(defaultdict):
    """Numbers words in the order they come; 0 ends a piece."""

    def __init__(self):
        super().__init__()
        self.default_factory = self.__len__
        self[b"."]


class _Stream:
    """The word numbers of one language that a task has not routed yet."""

    def __init__(self):
        self.numbers, self.parts, self.size = _Numbers(), [], 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def take(self, last: bool) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The words; the word numbers; and for each position how many words its suffix has (0 where
        a piece ends). Positions whose suffix is not known yet stay, unless it is the ``last`` time."""
        c = np.concatenate([*self.parts, np.zeros(LONGEST - 1 if last else 0, np.int32)])
        n = max(0, len(c) - (LONGEST - 1))
        live = c[:n] != 0
        length = live.astype(np.uint8)
        for k in range(1, LONGEST):
            live &= c[k:k + n] != 0
            length += live
        words = list(self.numbers)
        rest = [words[x] for x in c[n:]]
        self.numbers = _Numbers()
        self.parts = [np.fromiter(map(self.numbers.__getitem__, rest), np.int32, len(rest))]
        self.size = len(rest)
        return words, c, length


def _blob(values: list[np.ndarray], packer) -> bytes:
    """Arrays of one length in the narrowest common width, byte by byte (low bytes first)."""
    top = max((int(v.max()) for v in values if len(v)), default=0)
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64
    flat = np.concatenate([v.astype(kind) for v in values])
    return packer.compress(flat.view(np.uint8).reshape(-1, flat.itemsize).T.tobytes())


def _unblob(blob: bytes, n: int, arrays: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    width = len(raw) // (n * arrays)
    flat = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T)
    return flat.view(f"<u{width}").reshape(arrays, n)


def _packer():
    return zstandard.ZstdCompressor(level=3)


def _words_blob(words: list[bytes], packer) -> bytes:
    # a word holds no line feed: it ends a piece
    return packer.compress(b"\n".join(words))


def _words_of_blob(blob: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(blob).split(b"\n")


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def _route(of_word: np.ndarray, columns: list[np.ndarray], parts: int, lang: str) -> np.ndarray:
    """The part of each suffix, by the hashes of the words in ``columns``."""
    h = np.full(len(columns[0]), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
    for c in columns:
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + of_word[c])
    return (h % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.uint32)


def _blocks(words: list[bytes], columns_of: Callable, weights: np.ndarray | None, part: np.ndarray, depth: int,
            lang: str) -> Iterator[tuple]:
    """One row of ``BLOCKS`` for each part. ``columns_of(rows)``: the word numbers of some rows, an array for
    each place."""
    if not len(part):
        return
    packer = _packer()
    order = np.argsort(part, kind="stable")
    sizes = np.bincount(part)
    ends = np.cumsum(sizes)
    seen, to = np.zeros(len(words), bool), np.zeros(len(words), np.int32)
    for p in np.flatnonzero(sizes).tolist():
        rows = order[ends[p] - sizes[p]:ends[p]]
        mine = columns_of(rows)
        for c in mine:
            seen[c] = True
        seen[0] = True
        local = np.flatnonzero(seen)
        seen[local] = False
        to[local] = np.arange(len(local))  # 0 stays 0
        mine = [to[c] for c in mine]
        # by leading words: rows compress better
        by_words = np.argsort(mine[0].astype(np.int64) * len(local) + mine[1], kind="stable")
        data = [c[by_words] for c in mine] + ([] if weights is None else [weights[rows[by_words]]])
        yield p, depth, lang, len(rows), _words_blob([words[x] for x in local], packer), _blob(data, packer)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def _block_batch(rows: list[tuple]) -> pa.RecordBatch:
    return _batch(rows, ["part", "depth", "lang", "n", "words", "data"],
                  [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary()])


def _count_batch(rows: list[tuple]) -> pa.RecordBatch:
    return _batch(rows, ["lang", "phrase", "len", "f"], [pa.string(), pa.string(), pa.int32(), pa.int64()])


def routed(docs: DataFrame, parts: int) -> DataFrame:
    """``BLOCKS`` of the suffixes of two words or more, and the word counts as blocks of part ``WORDS``."""
    def blocks(stream: _Stream, lang: str, last: bool) -> Iterator[pa.RecordBatch]:
        words, c, length = stream.take(last)
        counts = np.bincount(c[:len(length)], minlength=1)
        counts[0] = 0
        there = np.flatnonzero(counts)
        if len(there):
            packer = _packer()
            yield _block_batch([(WORDS, 1, lang, len(there), _words_blob([words[x] for x in there], packer),
                                 _blob([counts[there]], packer))])
        at = np.flatnonzero(length > 1).astype(np.int32)
        if not len(at):
            return
        of_word = _word_hashes(words)
        part = np.concatenate([_route(of_word, [c[x], c[x + 1]], parts, lang) for x in np.split(at, range(STEP, len(at), STEP))])

        def columns_of(rows: np.ndarray) -> list[np.ndarray]:
            mine = at[rows]
            return [np.where(length[mine] > k, c[mine + k], 0) for k in range(LONGEST)]

        for row in _blocks(words, columns_of, None, part, 2, lang):
            yield _block_batch([row])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        streams: dict[str, _Stream] = defaultdict(_Stream)
        held = 0
        for b in batches:
            for lang, data in zip(b["lang"].to_pylist(), b["data"], strict=True):
                stream = streams[lang]
                for words in words_of(data.as_py()):
                    stream.add(words)
                    held += len(words)
                    if held >= FLUSH or len(stream.numbers) >= FLUSH_WORDS:
                        for name, s in streams.items():
                            yield from blocks(s, name, False)
                        held = 0
                stream.add([b"."])
        for name, s in streams.items():
            yield from blocks(s, name, True)

    return docs.mapInArrow(run, BLOCKS)


def sorted_counts(columns: np.ndarray, weights: np.ndarray | None, depth: int, least: int) -> Iterator[tuple[int, int, int]]:
    """(a row that starts with the phrase, its length, its count) of each phrase of ``depth`` words or more
    and weight ``least`` or more (no weights: one each): three-way multikey quicksort of pointers to rows."""
    def weight(rows: np.ndarray) -> int:
        return len(rows) if weights is None else int(weights[rows].sum())

    stack = [(np.arange(columns.shape[1], dtype=np.int32), 0)]
    while stack:
        rows, place = stack.pop()
        v = columns[place][rows]
        if place > 1:
            live = v != 0
            rows, v = rows[live], v[live]
        if weight(rows) < least:
            continue  # no phrase in here occurs often enough
        pivot = np.sort(v[:: max(1, len(v) // 9)])[min(len(v), 9) // 2]
        equal = rows[v == pivot]
        if len(equal) < len(rows):
            stack.append((rows[v < pivot], place))
            stack.append((rows[v > pivot], place))
        count = weight(equal)
        if count >= least:
            if place + 1 >= depth:
                yield int(equal[0]), place + 1, count
            if place + 1 < len(columns):
                stack.append((equal, place + 1))


def _gathered(blocks: list[dict]) -> tuple[list[bytes], np.ndarray, np.ndarray | None]:
    """Words, and the word numbers (a row for each place) and the weights of all rows of the blocks. Blocks
    that were routed once have none."""
    numbers, columns, weights = _Numbers(), [], []
    weighted = blocks[0]["depth"] > 2
    for b in blocks:
        to = np.fromiter(map(numbers.__getitem__, _words_of_blob(b["words"])), np.int32)
        arrays = _unblob(b["data"], b["n"], LONGEST + weighted)
        columns.append(to[arrays[:LONGEST]])
        if weighted:
            weights.append(arrays[-1].astype(np.int64))
    return list(numbers), np.concatenate(columns, axis=1), np.concatenate(weights) if weighted else None


def _by_lang(rows: list[dict]) -> dict[tuple, list[dict]]:
    out = defaultdict(list)
    for r in rows:
        out[r["lang"], r["depth"]].append(r)
    return out


def part_counts(blocks: DataFrame, least: int) -> DataFrame:
    """The frequent phrases of whole parts, as ``COUNTS``."""
    def run(part: pa.Table) -> pa.Table:
        found = []
        for (lang, depth), mine in _by_lang(part.to_pylist()).items():
            words, columns, weights = _gathered(mine)
            for row, n, count in sorted_counts(columns, weights, depth, least):
                found.append((lang, b" ".join(words[x] for x in columns[:n, row]).decode("utf-8", "replace"), n, count))
        return pa.Table.from_batches([_count_batch(found)])

    return blocks.groupBy("part").applyInArrow(run, COUNTS)


def routed_again(blocks: DataFrame, depth: int) -> DataFrame:
    """``BLOCKS`` (with a column ``split``: into how many parts) by ``depth`` words, equal suffixes as one row, and
    the counts of the phrases of ``depth - 1`` words as blocks of part ``WORDS``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _packer()
        for b in batches:
            for block in b.to_pylist():
                words, columns, weights = _gathered([block])
                if weights is None:
                    weights = np.ones(columns.shape[1], np.int64)
                order = np.lexsort(columns[::-1])
                columns, weights = columns[:, order], weights[order]
                starts = np.flatnonzero(np.r_[True, (columns[:, 1:] != columns[:, :-1]).any(axis=0)])
                columns, weights = columns[:, starts], np.add.reduceat(weights, starts)
                short = columns[:depth - 1]
                at = np.flatnonzero(np.r_[True, (short[:, 1:] != short[:, :-1]).any(axis=0)])
                phrases = [b" ".join(words[x] for x in short[:, k]) for k in at]
                yield _block_batch([(WORDS, depth - 1, block["lang"], len(at), _words_blob(phrases, packer),
                                     _blob([np.add.reduceat(weights, at)], packer))])
                long = np.flatnonzero(columns[depth - 1])
                columns, weights = columns[:, long], weights[long]
                part = _route(_word_hashes(words), list(columns[:depth]), block["split"], block["lang"])
                for new, *rest in _blocks(words, lambda rows, c=columns: list(c[:, rows]), weights, part, depth, block["lang"]):
                    yield _block_batch([(xxhash.xxh64_intdigest(f"{block['part']} {new}".encode()) >> 1, *rest)])

    return blocks.mapInArrow(run, BLOCKS)


def summed(blocks: DataFrame, least: int) -> DataFrame:
    """``COUNTS`` of the blocks of part ``WORDS``, summed; all words, and phrases of ``least`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                counts = _unblob(r["data"], r["n"], 1)[0]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["lang"]] * r["n"]), pa.array([w.decode("utf-8", "replace") for w in _words_of_blob(r["words"])]),
                    pa.array(np.full(r["n"], r["depth"], np.int32)), pa.array(counts.astype(np.int64))], names=["lang", "phrase", "len", "f"])

    rows = blocks.filter(F.col("part") == WORDS).mapInArrow(run, COUNTS)
    sums = rows.groupBy("lang", "phrase", "len").agg(F.sum("f").alias("f"))
    return sums.filter((F.col("f") >= least) | (F.col("len") == 1))


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``COUNTS`` of all words, and of the phrases of 2 to 5 words with ``least`` or more occurrences, stored.
    ``docs``: (lang, text)."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    size = docs.agg(F.sum(F.octet_length("data").cast("bigint"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    blocks = stored(routed(docs, parts), "op11-suffixes")
    found = [summed(blocks, least)]
    depth = 2
    while True:
        mine = blocks.filter(F.col("part") != WORDS)
        sizes = mine.groupBy("part").agg(F.sum("n").alias("rows"))
        large = sizes.filter(F.col("rows") > PART_ROWS) if depth < LONGEST else sizes.filter("false")
        large = stored(large.select("part", F.ceil(F.col("rows") / PART_ROWS).cast("int").alias("split")), f"op11-large-{depth}")
        found.append(part_counts(mine.join(large, "part", "left_anti"), least))
        if large.isEmpty():
            break
        depth += 1
        blocks = stored(routed_again(mine.join(large, "part"), depth), f"op11-suffixes-{depth}")
        found.append(summed(blocks, least))
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return stored(out, "op11-counts")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language by score."""
    counts = phrase_counts(take(docs, lang="string", text="string"), least)
    n = counts.filter("len = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counts.filter(F.col("f") >= least)
    candidates = frequent.filter("len > 1").select("lang", "phrase", "len", F.col("f").alias("a"))

    # the phrases one word shorter, at either end
    first = F.expr("substring_index(phrase, ' ', len - 1)")
    rest = F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)")
    inner = candidates.filter("len > 2").select("lang", F.explode(F.array(first, rest)).alias("phrase"), F.col("a").alias("outer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    alone = candidates.join(inner, ["lang", "phrase"], "left").filter("outer is null or outer < a").drop("outer")

    cut = alone.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("len") - 1)))
    cut = cut.withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
    cut = cut.withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cut = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(n, "lang")
    whole = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    cut = cut.withColumns({"above": F.lit(1000).cast("decimal(4,0)") * whole["a"] * whole["n"], "below": whole["l"] * whole["r"]})
    scored = cut.withColumn("score", F.expr("above div below"))
    worst = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("w"))
    worst = worst.select("lang", "phrase", "w.a", "w.l", "w.r", "w.n", "w.score")

    # few languages: ranked in groups first, so that the last ranking sees a bounded number of rows
    order = [F.desc("score"), F.desc("a"), "phrase"]
    group = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    near = worst.withColumn("g", group).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "g").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3), (4), (5)) AS t(k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, k, phrase, f AS a FROM f WHERE k > 1 AND f >= 100),
alone AS (
  SELECT * FROM cand c WHERE NOT EXISTS (
    SELECT 1 FROM cand o WHERE o.lang = c.lang AND o.k > c.k AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ')
      AND 100 * o.a >= 100 * c.a)),
cuts AS (
  SELECT lang, phrase, a, j, string_split(phrase, ' ') AS w FROM alone, (VALUES (1), (2), (3), (4)) AS t(j) WHERE j < k),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.j, l.f AS l, r.f AS r, t.n,
    CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.j + 1:], ' ')
  JOIN total t ON t.lang = c.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
  phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM worst QUALIFY rank <= 2000
"""
