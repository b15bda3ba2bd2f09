"""Suffix-array dedup: repeated byte strings by a distributed merge of sorted suffix runs.

Every byte covered by a string of LENGTH bytes that also starts in a document with a
smaller doc_id goes; overlaps count, and strings are judged on the input.

Which suffixes are sorted: a string of LENGTH bytes has one anchor, the leftmost of its
KMER-byte substrings with the least hash. Equal strings have equal anchors at equal
places, so it is enough to sort the suffixes that start at anchors, cut where the last
string with that anchor ends, together with the bytes before the anchor back to the
first such string (the anchor's context). Steps:

1. Documents are dealt to blocks by key. Each block sends the sorted hashes of its
   anchors, as packed differences, to parts by hash; a part answers each block with one
   bit for each hash: does it occur in another document? (48 bits of the hash: chance
   agreement only sorts a few suffixes more.)
2. Each block sorts the suffixes at repeated anchors, equal contexts once with their least
   doc_id, and sends them to the parts as front-coded runs.
   An anchor with more contexts than a bound, counted in step 1, does not go to one part:
   each of its strings goes as a context of its own, to parts by the string's hash.
3. A part merges its runs with a loser tree that keeps, for each run's head, the length
   of the prefix it shares with the last output: heads with different such lengths are
   ordered without a look at their bytes, others are compared from there on only. Suffixes
   that share the anchor form a group; for each string in it the least doc_id is found,
   in large groups by the common prefixes that the tree has kept. The answer goes back to
   the blocks: the least doc_id for each context, and those of its strings with a smaller one.
4. Each block marks the strings whose least doc_id is smaller than their document's.

A passage in a third of all documents is one suffix of each block's run. Blocks have a
bounded number of bytes (a document is in one block whole; its anchors are found piece by
piece).

Defined cases: null and empty texts have 0 bytes; texts shorter than LENGTH lose nothing;
documents of equal doc_id never take bytes from each other; a null doc_id comes after all
others; repeated rows each get their row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .common import documents, numbered, renumbered, stored, table
from .shingles import mix

LENGTH = 50
KMER = 24
#: strings that can share an anchor
REACH = LENGTH - KMER + 1
BLOCK_BYTES = 4 << 20
#: bytes hashed at a time
SEGMENT_BYTES = 1 << 18
#: contexts cut out at a time
ROWS = 8192
HASH_BITS = 48
#: an anchor's occurrences in a block beyond which its different contexts there are counted (up to so many count as so many)
FEW = 8
#: contexts of one anchor beyond which its strings are dealt to the parts one by one
HOT_CONTEXTS = 200_000
#: contexts of a group beyond which its strings are found by arrays
LARGE = 256
_BASE = 0x9E3779B97F4A7C15 | 1
_POWER = [pow(_BASE, 1 << k, 1 << 64) for k in range(5)]
NO_ID = np.iinfo(np.int64).max


def kmer_hashes(a: np.ndarray) -> np.ndarray:
    """Hash of each KMER-byte substring of ``a`` (uint8), by doubling."""
    h = mix(a.astype(np.uint64) + np.uint64(1))
    by_size = {1: h}
    for k in range(4):
        n = 1 << k
        h = h[:-n] * np.uint64(_POWER[k]) + h[n:]
        by_size[2 * n] = h
    return mix(by_size[16][:-8] * np.uint64(_POWER[3]) + by_size[8][16:])


def anchors(a: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(p, lo, hi, hash) of the anchors in the documents that end at ``ends`` in ``a``: the anchor's
    place, the first and last string with it, the hash of its KMER bytes."""
    none = np.zeros(0, np.int64)
    if len(a) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    hashes = kmer_hashes(a)
    place = np.uint64((1 << 28) - 1)
    low = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= REACH:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < REACH:
        low = np.minimum(low[: len(a) - LENGTH + 1], low[REACH - size:])
    p = (low & place).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(len(a) + 1, np.int32)
    long = ends - starts >= LENGTH
    inside[starts[long]] += 1
    inside[ends[long] - LENGTH + 1] -= 1
    at = np.flatnonzero(np.cumsum(inside)[: len(p)] > 0)
    if not len(at):
        return none, none, none, none.astype(np.uint64)
    own = p[at]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(own) - 1]])
    return own[first], at[first], at[last], hashes[own[first]]


def _row_hashes(m: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes."""
    padded = np.zeros((len(m), -(-m.shape[1] // 8) * 8), np.uint8)
    padded[:, :m.shape[1]] = m
    h = np.zeros(len(m), np.uint64)
    for column in padded.view(np.uint64).T:
        h = mix(h * np.uint64(_BASE) + column)
    return h


def _is_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted ``among``."""
    if not len(among):
        return np.zeros(len(values), bool)
    at = np.searchsorted(among, values)
    at[at == len(among)] = 0
    return among[at] == values


class Block:
    """The documents of one block and their anchors: ``p`` the anchor's place, ``left`` how many bytes before it
    its first string starts, ``right`` how many bytes from it on its last string ends."""

    def __init__(self, rows: pd.DataFrame):
        open_ = zstandard.ZstdDecompressor().decompress
        self.rows = rows.sort_values(["k", "h"], ignore_index=True)
        texts = [open_(z) for z in self.rows["z"]]
        self.ids = np.where(self.rows["no_id"].to_numpy(bool), NO_ID, self.rows["k"].to_numpy(np.int64))
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
        found = []
        for a, b, ends in self._segments():
            p, lo, hi, hashes = anchors(self.data[a:b], ends)
            # anchors have the least hashes: mixed again, they spread evenly over the parts
            found.append((p + a, (p - lo).astype(np.uint8), (hi + LENGTH - p).astype(np.uint8), mix(hashes) >> np.uint64(64 - HASH_BITS)))
        if not found:
            found = [tuple(np.zeros(0, t) for t in (np.int64, np.uint8, np.uint8, np.uint64))]
        self.p, self.left, self.right, self.hash = (np.concatenate(x) for x in zip(*found, strict=True))
        self.doc = np.searchsorted(self.ends, self.p, side="right").astype(np.int32)

    def _segments(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(start, end, ends of the documents in it): each string starts in one segment and lies in it whole, also
        where a document is longer."""
        for a in range(0, len(self.data), SEGMENT_BYTES):
            b = min(a + SEGMENT_BYTES + LENGTH - 1, len(self.data))
            ends = self.ends[np.searchsorted(self.ends, a, side="right"):np.searchsorted(self.ends, b)]
            yield a, b, np.append(ends, b) - a

    def distinct(self) -> tuple[np.ndarray, ...]:
        """Sorted distinct anchor hashes; whether two documents of this block share them; the numbers of those
        with more than FEW occurrences, and how many different contexts they have."""
        order = np.lexsort((self.ids[self.doc], self.hash))
        h, d = self.hash[order], self.ids[self.doc][order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        size = np.diff(first, append=len(h))
        many = np.flatnonzero(size > FEW)
        rows = np.repeat(size > FEW, size)
        at = np.repeat(np.arange(len(first)), size)[rows]
        which = order[rows]
        context = np.concatenate([np.zeros(0, np.uint64)] + [
            _row_hashes(self._matrix(*(x[which[k:k + ROWS]] for x in (self.p, self.left, self.right)))) for k in range(0, len(which), ROWS)])
        by_context = np.lexsort((context, at))
        at, context = at[by_context], context[by_context]
        new = np.concatenate([[True], (at[1:] != at[:-1]) | (context[1:] != context[:-1])]) if len(at) else np.zeros(0, bool)
        contexts = np.bincount(at[new], minlength=len(first))[many]
        return h[first], d[first] != d[first + size - 1], many.astype(np.int32), contexts.astype(np.int32)

    def _matrix(self, p: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """A row for each context: its suffix, how long it is, the bytes before the anchor backwards, their number."""
        m = np.zeros((len(p), LENGTH + REACH + 1), np.uint8)
        for k in range(0, len(p), ROWS):
            part = slice(k, k + ROWS)
            for start, n, column, step in ((p, right, 0, 1), (p - 1, left, LENGTH + 1, -1)):
                reach = np.arange(LENGTH if step == 1 else REACH - 1)
                inside = reach < n[part, None]
                m[part, column:column + len(reach)] = np.where(
                    inside, self.data[np.where(inside, start[part, None] + step * reach, 0)], 0)
        m[:, LENGTH] = right
        m[:, LENGTH + REACH] = left
        return m

    def contexts(self, repeated: np.ndarray, hot: np.ndarray) -> None:
        """Sorts the contexts at anchors whose hash is in ``repeated`` (where it is also in ``hot``, each of their
        strings as a context of its own): ``sorted`` rows as in ``_matrix``, equal ones once; ``least`` their
        smallest id, ``part_of`` the hash that they go by; of each occurrence, ``at`` the anchor's place, ``lo`` and
        ``hi`` its first and last string, ``id_of`` its document's id, ``entry`` its row."""
        which = np.flatnonzero(_is_in(self.hash, repeated))
        left, right = self.left[which].astype(np.int64), self.right[which].astype(np.int64)
        split = _is_in(self.hash[which], hot)
        if split.any():
            times = np.where(split, left + right - LENGTH + 1, 1)
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            which, left, right, split = (np.repeat(x, times) for x in (which, left, right, split))
            left = np.where(split, left - step, left)
            right = np.where(split, LENGTH - left, right)
        self.at = self.p[which]
        self.lo, self.hi = self.at - left, self.at + right - LENGTH
        self.id_of = self.ids[self.doc[which]]
        n = len(which)
        m = self._matrix(self.at, left, right)
        goes_by = self.hash[which]
        goes_by[split] = _row_hashes(m[split]) >> np.uint64(64 - HASH_BITS)
        as_one = np.ascontiguousarray(m).view(f"V{m.shape[1]}").ravel()
        order = np.argsort(as_one, kind="stable") if n else np.zeros(0, np.int64)
        s = m[order]
        new = np.concatenate([[True], (s[1:] != s[:-1]).any(axis=1)]) if n else np.zeros(0, bool)
        first = np.flatnonzero(new)
        self.entry = np.empty(n, np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.sorted = s[first]
        ids = self.id_of[order]
        self.least = np.minimum.reduceat(ids, first) if n else ids
        self.part_of = goes_by[order][first]


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(HASH_BITS - 24)) * np.uint64(parts)) >> np.uint64(24)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed record; integers by byte planes, so equal high bytes cost little."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T if len(a) else np.zeros(0, np.uint8)
        out += [np.array([len(a)], np.int64).tobytes(), a.dtype.str.encode().ljust(8), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(data: bytes) -> list[np.ndarray]:
    data, out, at = zstandard.ZstdDecompressor().decompress(data), [], 0
    while at < len(data):
        n, kind = int(np.frombuffer(data, np.int64, 1, at)[0]), np.dtype(data[at + 8:at + 16].decode().strip())
        size = n * kind.itemsize
        planes = np.frombuffer(data, np.uint8, size, at + 16).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += 16 + size
    return out


def _send_hashes(parts: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows)
        h, twice, many, contexts = block.distinct()
        cuts = np.searchsorted(_part(h, parts), np.arange(parts + 1, dtype=np.uint64))
        out = []
        for j, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                own = slice(*np.searchsorted(many, (a, b)))
                data = _pack(np.diff(h[a:b], prepend=np.uint64(0)), np.packbits(twice[a:b]), many[own] - np.int32(a), contexts[own])
                out.append((int(rows["block"].iloc[0]), j, data))
        return pd.DataFrame(out, columns=["block", "part", "data"])

    return run


def _find_repeated(rows: pd.DataFrame) -> pd.DataFrame:
    runs, several = [], []
    for data in rows["data"]:
        gaps, twice, many, contexts = _unpack(data)
        h = np.cumsum(gaps, dtype=np.uint64)
        several += [h, h[np.unpackbits(twice, count=len(h)).astype(bool)]]
        runs.append((h, many, contexts))
    every = np.sort(np.concatenate(several))
    repeated = np.unique(every[1:][every[1:] == every[:-1]])
    total = np.zeros(len(repeated), np.int64)
    for h, many, contexts in runs:
        count = np.full(len(h), FEW)
        count[many] = contexts
        there = _is_in(h, repeated)
        total[np.searchsorted(repeated, h[there])] += count[there]
    hot = repeated[total > HOT_CONTEXTS]
    out = []
    for block, (h, _, _) in zip(rows["block"], runs, strict=True):
        data = _pack(np.packbits(_is_in(h, repeated)), np.flatnonzero(_is_in(h, hot)))
        out.append((int(block), int(rows["part"].iloc[0]), data))
    return pd.DataFrame(out, columns=["block", "part", "data"])


def _repeated_in(block: Block, replies: pd.DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The block's hashes that are repeated anywhere, and those of them with too many contexts."""
    h = np.unique(block.hash)
    cuts = np.searchsorted(_part(h, parts), np.arange(parts + 1, dtype=np.uint64))
    out, hot = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for part, data in zip(replies["part"], replies["data"], strict=True):
        own = h[cuts[part]:cuts[part + 1]]
        bits, many = _unpack(data)
        out.append(own[np.unpackbits(bits, count=len(own)).astype(bool)])
        hot.append(own[many])
    return np.sort(np.concatenate(out)), np.sort(np.concatenate(hot))


def front_coded(rows: np.ndarray, least: np.ndarray) -> bytes:
    """A sorted run of contexts: the length of the prefix that each suffix shares with the one before, and the rest."""
    suffix, right, left = rows[:, :LENGTH], rows[:, LENGTH], rows[:, -1]
    shared = np.zeros(len(rows), np.uint8)
    shared[1:] = np.logical_and.accumulate(suffix[1:] == suffix[:-1], axis=1).sum(axis=1)
    column = np.arange(LENGTH)
    tails = suffix[(column >= shared[:, None]) & (column < right[:, None])]
    before = rows[:, LENGTH + 1:-1][np.arange(REACH - 1) < left[:, None]]
    return _pack(shared, right, left, tails, before, least)


def _send_runs(parts: int):
    def run(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(replies):
            block = Block(rows)
            block.contexts(*_repeated_in(block, replies, parts))
            part_of = _part(block.part_of, parts)
            for j in np.unique(part_of):
                own = part_of == j
                out.append((int(rows["block"].iloc[0]), int(j), front_coded(block.sorted[own], block.least[own])))
        return pd.DataFrame(out, columns=["block", "part", "data"])

    return run


class Run:
    """A front-coded run, read entry by entry."""

    def __init__(self, data: bytes):
        shared, self.rights, self.lefts, tails, before, self.least = _unpack(data)
        self.shared, self.right, self.left = shared.tolist(), self.rights.tolist(), self.lefts.tolist()
        self.answer = self.least.copy()
        # entry, bytes before the anchor, least id: strings whose least id is not the entry's
        self.special = array("i"), array("B"), array("q")
        self._tails, self._before = tails.tobytes(), before.tobytes()
        self._tail = self._back = 0
        self.at, self.suffix, self.back = -1, b"", b""

    def advance(self) -> int:
        """To the next entry; the prefix it shares with the last one, -1 at the end."""
        self.at += 1
        k = self.at
        if k == len(self.shared):
            return -1
        shared, right, left = self.shared[k], self.right[k], self.left[k]
        # a suffix that ends within the shared prefix has zeros after its end, like the one before
        more = max(right - shared, 0)
        head = self.suffix[:shared] + self._tails[self._tail:self._tail + more]
        self.suffix = head.ljust(LENGTH, b"\0")
        self._tail += more
        self.back = self._before[self._back:self._back + left]
        self._back += left
        return shared


def merged(runs: list[Run]) -> Iterator[tuple[int, int]]:
    """(run number, shared prefix with the last output) of every entry, in the order of the suffixes.

    A loser tree: ``shared[r]`` is how long a prefix the head of r shares with the last
    output. The longer one is the smaller suffix; equal ones are compared from there on."""
    size = 1
    while size < len(runs):
        size *= 2
    shared = [r.advance() for r in runs] + [-1] * (size - len(runs))
    shared = [-1 if s < 0 else 0 for s in shared]
    heads = [r.suffix for r in runs] + [b""] * (size - len(runs))
    tree = [0] * (2 * size)

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)."""
        x, y = shared[a], shared[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        s, t = heads[a], heads[b]
        if s[x:] == t[x:]:
            shared[b] = LENGTH
            return a, b
        while s[x] == t[x]:
            x += 1
        if s[x] < t[x]:
            shared[b] = x
            return a, b
        shared[a] = x
        return b, a

    winners = [0] * (2 * size)
    winners[size:] = range(size)
    for k in range(size - 1, 0, -1):
        winners[k], tree[k] = play(winners[2 * k], winners[2 * k + 1])
    w = winners[1]
    while shared[w] >= 0:
        yield w, shared[w]
        shared[w] = runs[w].advance()
        heads[w] = runs[w].suffix
        k = (w + size) >> 1
        while k:
            w, tree[k] = play(w, tree[k])
            k >>= 1


def _note(run: Run, k: int, o: int, least: int) -> None:
    for column, value in zip(run.special, (k, o, least), strict=True):
        column.append(value)


def _answer(runs: list[Run], group: list[tuple[int, int, int, bytes, bytes]]) -> None:
    """Finds the least id of each string of a group (run, entry, shared prefix, suffix, bytes before backwards)."""
    least: dict[tuple, int] = {}
    for r, k, _, suffix, back in group:
        c = (suffix, runs[r].right[k], back)
        own = int(runs[r].least[k])
        if own < least.get(c, NO_ID + 1):
            least[c] = own
    if len(least) == 1:
        for r, k, *_ in group:
            runs[r].answer[k] = next(iter(least.values()))
        return
    strings: dict[tuple, int] = {}
    keys: dict[tuple, list[tuple]] = {}
    for c, own in least.items():
        suffix, right, back = c
        left = len(back)
        turned = back[::-1]
        keys[c] = [(o, turned[left - o:] + suffix[:LENGTH - o]) for o in range(left, LENGTH - right - 1, -1)]
        for s in keys[c]:
            if own < strings.get(s, NO_ID + 1):
                strings[s] = own
    answers = {c: [strings[s] for s in ks] for c, ks in keys.items()}
    for r, k, _, suffix, back in group:
        values = answers[suffix, runs[r].right[k], back]
        own = int(runs[r].least[k])
        if min(values) == max(values):
            runs[r].answer[k] = values[0]
            continue
        for o, value in zip(range(len(back), -1, -1), values, strict=False):
            if value < own:
                _note(runs[r], k, o, value)


class _Group:
    """The contexts of one anchor, in the order of their suffixes. A large group is held as bytes."""

    def __init__(self):
        self.rows: list[tuple[int, int, int, bytes, bytes]] = []
        self.run, self.at, self.shared, self.back = array("i"), array("i"), array("B"), bytearray()

    def add(self, row: tuple[int, int, int, bytes, bytes]) -> None:
        self.rows.append(row)
        if len(self.rows) > ROWS:
            self._pack()

    def _pack(self) -> None:
        for r, k, shared, _, back in self.rows:
            self.run.append(r)
            self.at.append(k)
            self.shared.append(shared)
            self.back += back.ljust(32, b"\0")
        self.rows = []

    def answer(self, runs: list[Run]) -> None:
        if len(self.rows) <= LARGE and not self.run:
            if len(self.rows) > 1:
                _answer(runs, self.rows)
            return
        self._pack()
        self._answer_large(runs)

    def _answer_large(self, runs: list[Run]) -> None:
        """As ``_answer``. The strings that start o bytes before the anchor are equal only inside a run of neighbours
        with a common prefix of LENGTH - o bytes or more, where the o bytes before agree: these are ordered
        backwards once, so that agreement is a run of neighbours of that order."""
        n = len(self.run)
        run, at = np.frombuffer(self.run, np.int32), np.frombuffer(self.at, np.int32)
        shared = np.frombuffer(self.shared, np.uint8)
        back = np.frombuffer(bytes(self.back), np.uint8).reshape(n, 32)
        own, left, right = np.empty(n, np.int64), np.empty(n, np.uint8), np.empty(n, np.uint8)
        of_run = np.argsort(run, kind="stable")
        for rows in np.split(of_run, np.flatnonzero(np.diff(run[of_run])) + 1):
            r = runs[run[rows[0]]]
            own[rows], left[rows], right[rows] = r.least[at[rows]], r.lefts[at[rows]], r.rights[at[rows]]
        backwards = np.lexsort(back.view(">u8").astype(np.uint64).T[::-1])
        agree = np.zeros(n, np.uint8)
        for k in range(1, n, ROWS):
            x, y = back[backwards[k - 1:k - 1 + ROWS]], back[backwards[k:k + ROWS]]
            agree[k:k + ROWS] = np.logical_and.accumulate(x[:len(y)] == y, axis=1).sum(axis=1)
        low, high = np.full(n, NO_ID), np.full(n, -NO_ID)
        found = []
        for o in range(REACH):
            after = np.cumsum(shared < LENGTH - o)
            before = np.empty(n, np.int64)
            before[backwards] = np.cumsum(agree < o)
            there = np.flatnonzero((left >= o) & (right >= LENGTH - o))
            if not len(there):
                continue
            key = after[there] * (n + 1) + before[there]
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
            least = np.empty(len(there), np.int64)
            least[order] = np.repeat(np.minimum.reduceat(own[there][order], first), np.diff(first, append=len(there)))
            low[there], high[there] = np.minimum(low[there], least), np.maximum(high[there], least)
            less = least < own[there]
            found.append((there[less].astype(np.int32), np.full(less.sum(), o, np.uint8), least[less]))
        for k in np.flatnonzero((low == high) & (low < own)).tolist():
            runs[run[k]].answer[at[k]] = low[k]
        for rows, o, least in found:
            differ = low[rows] != high[rows]
            for k, value in zip(rows[differ].tolist(), least[differ].tolist(), strict=True):
                _note(runs[run[k]], int(at[k]), int(o[0]), value)


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    runs = [Run(data) for data in rows["data"]]
    group = _Group()
    for w, shared in merged(runs):
        if shared < KMER:
            group.answer(runs)
            group = _Group()
        r = runs[w]
        group.add((w, r.at, shared, r.suffix, r.back))
    group.answer(runs)
    out = [(int(block), int(rows["part"].iloc[0]), _pack(r.answer, *(np.array(x) for x in r.special)))
           for block, r in zip(rows["block"], runs, strict=True)]
    return pd.DataFrame(out, columns=["block", "part", "data"])


def _covered(block: Block, answers: pd.DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of bytes that go, in order; none lies in two documents."""
    least, part_of = block.least.copy(), _part(block.part_of, parts)
    special = [(np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.int64))]
    for part, data in zip(answers["part"], answers["data"], strict=True):
        answer, which, o, values = _unpack(data)
        own = np.flatnonzero(part_of == np.uint64(part))
        least[own] = answer
        special.append((own[which], o, values))
    whole = least[block.entry] < block.id_of
    # of the other occurrences, the strings whose least id is another than their context's
    entry, o, values = (np.concatenate(x) for x in zip(*special, strict=True))
    order = np.argsort(entry, kind="stable")
    count = np.bincount(entry, minlength=len(least))
    rest = np.flatnonzero(~whole & (count[block.entry] > 0))
    times = count[block.entry[rest]]
    at = order[np.repeat((np.cumsum(count) - count)[block.entry[rest]] - np.cumsum(times) + times, times) + np.arange(times.sum())]
    rest = np.repeat(rest, times)
    single = values[at] < block.id_of[rest]
    alone = block.at[rest[single]] - o[at[single]]
    start = np.concatenate([block.lo[whole], alone])
    end = np.concatenate([block.hi[whole], alone]) + LENGTH
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    doc = np.searchsorted(block.ends, start, side="right")
    first = np.flatnonzero(np.concatenate([[True], (start[1:] > reach[:-1]) | (doc[1:] != doc[:-1])])) if len(start) else order
    return start[first], reach[np.append(first[1:], len(start)) - 1] if len(start) else reach


def _apply(parts: int, with_text: bool):
    def run(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows)
        bits, answers = replies[replies["kind"] == 0], replies[replies["kind"] == 1]
        block.contexts(*_repeated_in(block, bits, parts))
        begins, stops = _covered(block, answers, parts)
        bounds = np.searchsorted(begins, np.concatenate([[0], block.ends]))
        data, out, start = memoryview(block.data), [], 0
        for k, no_id, end, a, b in zip(block.rows["k"], block.rows["no_id"], block.ends.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            cuts = [start, *np.stack([begins[a:b], stops[a:b]], axis=1).ravel().tolist(), end]
            kept = [data[x:y] for x, y in zip(cuts[::2], cuts[1::2], strict=True)]
            digest = hashlib.sha256()
            for piece in kept:
                digest.update(piece)
            n = end - start - sum(map(len, kept))
            out.append((k, no_id, end - start, n, b - a, digest.hexdigest(), b"".join(kept) if with_text else None))
            start = end
        return pd.DataFrame(out, columns=["k", "no_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def dedup_substrings(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept`` (the bytes that stay,
    null unless ``with_text``). Eager: the steps' results are stored."""
    spark = docs.sparkSession
    docs = documents(docs)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_BYTES))
    parts = max(blocks // 2, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            yield b.assign(z=[pack((t or "").encode("utf-8", "replace")) for t in b["text"]]).drop(columns="text")

    blocked = (
        numbered(docs).select("k", "no_id", "h", "text").mapInPandas(shrink, "k bigint, no_id boolean, h bigint, z binary")
        .withColumn("block", F.pmod(F.xxhash64("k", "h"), F.lit(blocks)).cast("int"))
        .repartition(blocks, "block").persist(StorageLevel.DISK_ONLY))
    try:
        message = "block int, part int, data binary"
        hashes = blocked.groupBy("block").applyInPandas(_send_hashes(parts), message)
        replies = stored(hashes.repartition(parts, "part").groupBy("part").applyInPandas(_find_repeated, message), "op2-replies")
        by_block = blocked.groupBy("block")
        runs = by_block.cogroup(replies.groupBy("block")).applyInPandas(_send_runs(parts), message)
        answers = stored(runs.repartition(parts, "part").groupBy("part").applyInPandas(_merge, message), "op2-answers")
        both = replies.withColumn("kind", F.lit(0)).unionByName(answers.withColumn("kind", F.lit(1)))
        return stored(renumbered(by_block.cogroup(both.groupBy("block")).applyInPandas(
            _apply(parts, with_text),
            "k bigint, no_id boolean, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")), "op2-result")
    finally:
        blocked.unpersist()


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).drop("kept")
