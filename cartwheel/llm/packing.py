"""Best-fit packing: documents into sequences of at most 2048 tokens.

A document's tokens end with id 0. One of more than 2048 is cut into pieces, full
ones but the first. Each task packs what it has tokenised, in arrival order: a
piece goes into the open sequence with the least free space that holds it, found by
one shift and one lowest-bit step in a bitset keyed by free space. A fixed number of
sequences is open at a time; when another must be opened, the fullest closes first.
Sequences still open at a task's end give their pieces (ids and lengths only) back,
to be packed again, by tasks that each take the rest of many: so what stays partly
filled does not grow with the number of tasks. Memory is bounded by the open
sequences and one batch.

Ids are those of the tokenizer file named in the query's contract with its default
settings. A faster byte-pair encoder with the same vocabulary tokenises what lies between
the tokens that the file adds; texts with a very long run of white space, which it
cannot take, go to the tokenizer itself (tests compare both).

Defined cases: a null or empty text is one piece, id 0 alone; the strings of added tokens
(such as the end-of-text mark) are their ids; repeated rows and rows without a doc_id are
packed like any other; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, renumbered, stored, table, take

SEQUENCE_TOKENS = 2048
OPEN_BINS = 512
#: tasks of one round whose unfinished sequences one task of the next round takes
FAN_IN = 32
END_ID = 0
#: characters of a run of white space that the fast encoder is still given
LONG_BLANK = 10_000
TOKENIZER = "byte_bpe_50k"
PIECE = "k bigint, no_id boolean, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = f"{PIECE}, sequence_id bigint, offset bigint, open boolean"


class OpenBins:
    """A bounded number of open sequences; ``place`` returns those that close."""

    def __init__(self, capacity: int = SEQUENCE_TOKENS, limit: int = OPEN_BINS):
        self.capacity, self.limit, self.count = capacity, limit, 0
        self.free = 0  # bit f is set while some open sequence has f free tokens
        self.by_free: dict[int, list[list]] = {}

    def _take(self, f: int) -> list:
        bins = self.by_free[f]
        out = bins.pop()
        if not bins:
            del self.by_free[f]
            self.free &= ~(1 << f)
        self.count -= 1
        return out

    def _put(self, f: int, pieces: list) -> None:
        self.by_free.setdefault(f, []).append(pieces)
        self.free |= 1 << f
        self.count += 1

    def place(self, piece, length: int) -> list[list]:
        closed = []
        fits = self.free >> length
        if fits:
            f = length + (fits & -fits).bit_length() - 1
            pieces = self._take(f)
        else:
            f, pieces = self.capacity, []
            if self.count == self.limit and length < self.capacity:
                closed.append(self._take((self.free & -self.free).bit_length() - 1))
        pieces.append(piece)
        if f == length:
            closed.append(pieces)
        else:
            self._put(f - length, pieces)
        return closed

    def rest(self) -> list[list]:
        return [pieces for bins in self.by_free.values() for pieces in bins]


class Encoder:
    """The ids of a text, as the tokenizer file gives them."""

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.file = public_tokenizers.path(f"{name}.json")
        with open(self.file, encoding="utf-8") as f:
            self.added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.added else None
        self.whole = None

    def _plain(self, text: str) -> list[int]:
        if len(text) > LONG_BLANK and any(m.end() - m.start() > LONG_BLANK for m in re.finditer(r"\s+", text)):
            if self.whole is None:
                from tokenizers import Tokenizer
                self.whole = Tokenizer.from_file(self.file)
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def ids(self, text: str) -> list[int]:
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        out = []
        for part in self.cut.split(text):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out += self._plain(part)
        return out


def pieces_of(n: int, size: int = SEQUENCE_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full but the first."""
    head = n % size or min(n, size)
    return [(0, head)] + [(s, size) for s in range(head, n, size)]


def _rows(sequences: list[list], number: int, last: bool) -> Iterator[tuple]:
    """The rows of sequences numbered from ``number``; ``last``: they were open at the end."""
    for k, pieces in enumerate(sequences):
        at = 0
        for p in pieces:
            yield (*p, number + k, at, last)
            at += p[LENGTH]


LENGTH = 4  # of the columns of a piece, its length
COLUMNS = ["k", "no_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "open"]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=COLUMNS)


def _packer(pieces, level: int, bins: int, final: bool):
    """A mapInPandas function: packs the pieces that ``pieces(batch)`` yields."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = (level << 56) | (TaskContext.get().partitionId() << 28)
        held, read = OpenBins(limit=bins), pieces()
        for b in batches:
            closed = [c for p in read(b) for c in held.place(p, p[LENGTH])]
            yield _frame(list(_rows(closed, number, False)))
            number += len(closed)
        yield _frame(list(_rows(held.rest(), number, not final)))

    return run


def _tokenised(name: str, size: int):
    def pieces():
        encoder = Encoder(name)

        def read(batch: pd.DataFrame) -> Iterator[tuple]:
            for k, no_id, text in zip(batch["k"], batch["no_id"], batch["text"], strict=True):
                ids = np.array([*encoder.ids(text or ""), END_ID], dtype="<u4")
                for piece, (start, length) in enumerate(pieces_of(len(ids), size)):
                    yield k, no_id, piece, start, length, zlib.crc32(ids[start:start + length].tobytes())

        return read

    return pieces


def _again():
    def read(batch: pd.DataFrame) -> Iterator[tuple]:
        return batch[COLUMNS[:6]].itertuples(index=False, name=None)

    return read


def pack(docs: DataFrame, bins: int = OPEN_BINS, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Eager: each
    round's placements are stored, so a document is tokenised once."""
    docs = numbered(take(docs, doc_id="bigint", text="string"))
    done = stored(docs.mapInPandas(_packer(_tokenised(tokenizer, SEQUENCE_TOKENS), 1, bins, False), PLACED), "op6-round1")
    # tasks that left a sequence open; every round has at most a FAN_IN-th as many
    tasks = done.filter("open").agg(F.count_distinct(F.shiftright("sequence_id", 28)).alias("n")).first()["n"]
    out, level = done.filter(~F.col("open")), 1
    while True:
        level, tasks = level + 1, max(1, -(-tasks // FAN_IN))
        rest = done.filter("open").repartition(tasks, F.xxhash64("k", "piece", "ids_crc32", "sequence_id")).select(*COLUMNS[:6])
        done = stored(rest.mapInPandas(_packer(_again, level, bins, tasks == 1), PLACED), f"op6-round{level}")
        out = out.unionByName(done.filter(~F.col("open")))
        if tasks == 1:
            return renumbered(out.drop("open"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
