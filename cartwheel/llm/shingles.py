"""Words and word shingles of a text as 64-bit hashes, computed on arrays.

A word's hash is a polynomial in its bytes, taken from one running sum over the
text, then mixed; a shingle's mixes the hashes of its words in order.
"""

from __future__ import annotations

import numpy as np

#: bytes hashed at a time; a piece ends at white space
PIECE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: ASCII but letters and digits becomes a space
_NO_PUNCTUATION = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit numbers without visible structure."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class WordHasher:
    """Hashes the words of texts; holds the powers it has needed so far."""

    def __init__(self):
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            n = max(n, 2 * len(self._powers), 4096)
            with np.errstate(over="ignore"):
                for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
                    steps = np.full(n, base, np.uint64)
                    steps[0] = 1
                    setattr(self, name, np.multiply.accumulate(steps))

    def words(self, text: str | None) -> np.ndarray:
        """Hash of each word: A-Z lower-cased, cut at spaces and U+0009 to U+000D."""
        data = (text or "").encode("utf-8", "replace").lower()
        if len(data) <= PIECE_BYTES:
            return self._piece(data)
        out, at = [], 0
        while at < len(data):
            end = at + PIECE_BYTES
            while end < len(data) and data[end] not in b" \t\n\v\f\r":
                end += 1
            out.append(self._piece(data[at:end]))
            at = end
        return np.concatenate(out)

    def _piece(self, data: bytes, prefixes: tuple[int, ...] = ()) -> np.ndarray:
        a = np.frombuffer(data, np.uint8)
        self._grow(len(a) + 1)
        inside = np.zeros(len(a) + 2, np.int8)
        inside[1:-1] = (a != 32) & ((a < 9) | (a > 13))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((a.astype(np.uint64) + np.uint64(1)) * self._powers[: len(a)], out=sums[1:])
        out = mix((sums[end] - sums[start]) * self._inverses[start])
        if not prefixes:
            return out
        parts = [out]
        for n in prefixes:
            s = start[end - start >= n]
            parts.append(mix((sums[s + n] - sums[s]) * self._inverses[s] + np.uint64(n)))
        return np.concatenate(parts)

    def words_and_prefixes(self, text: str | None, prefixes: tuple[int, ...]) -> np.ndarray:
        """Distinct hashes of the words, without ASCII punctuation, and of their first bytes."""
        data = (text or "").lower().encode("utf-8", "replace").translate(_NO_PUNCTUATION)
        out, at = [np.zeros(0, np.uint64)], 0
        while at < len(data):
            end = at + PIECE_BYTES
            while end < len(data) and data[end] != 32:
                end += 1
            out.append(np.unique(self._piece(data[at:end], prefixes)))
            at = end
        return np.unique(np.concatenate(out))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in order; of fewer words, the whole sequence as one."""
    n = min(size, len(words))
    if n == 0:
        return words
    runs = len(words) - n + 1
    h = np.full(runs, n, np.uint64)
    for k in range(n):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + words[k:k + runs])
    return h
