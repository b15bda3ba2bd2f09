import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import SF, check_oracle

from cartwheel.llm import collocations as co

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    """The result over (lang, text) rows, by counting every phrase."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inner = {q[i:j] for q, b in candidates.items() for i in range(len(q)) for j in range(i + 1, len(q) + 1)
                 if j - i < len(q) and b >= counts[q[i:j]]}
        found = []
        for p, a in candidates.items():
            if p not in inner:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((score, a, " ".join(p), counts[p[:k]], counts[p[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, r + 1, p, a, le, ri, n[lang], score) for r, (score, a, p, le, ri) in enumerate(found[:top])]
    return sorted(out)


def got(df, least, top):
    return sorted(tuple(r) for r in co.collocations(df, least, top).collect())


def test_oracle(spark):
    check_oracle(spark, "op11_collocations", SF)


def test_edge_cases(edge, rows):
    expected = brute([(None if i == 7 else "en", t) for i, t in rows], 3, 50)
    assert len({r[0] for r in expected}) >= 1 and len(expected) == 50
    assert got(edge, 3, 50) == expected


def test_empty(empty):
    assert got(empty, 100, 2000) == []


@pytest.fixture
def awkward(spark):
    hot = "the hot pair goes " * 40
    rows = [("x", hot + str(k % 7)) for k in range(30)] + [
        (None, "A b. a B, a b! a-b a b"), ("und", "a b\ta  b\x0ba b"), ("", "a b a b"), ("x", "Ünï É ünï é Ünï É"),
        ("x", None), ("x", ""), ("x", " .,;:!?\n\r\x0b\x0c\t "), ("x", "\x1c word\x00 \x1c word\x00"), ("y", "z " * 2000)]
    return spark.createDataFrame(rows, "lang string, text string"), rows


def test_words_and_pieces(awkward):
    df, rows = awkward
    assert got(df, 2, 100) == brute(rows, 2, 100)


def test_hot_parts_are_routed_again(awkward, monkeypatch):
    """Tiny blocks, reads and parts: texts are cut everywhere, hot pairs go on to five words."""
    df, rows = awkward
    for name, value in (("PART_ROWS", 40), ("FLUSH", 300), ("PIECE_BYTES", 50), ("PART_BYTES", 2000), ("RANK_GROUPS", 3)):
        monkeypatch.setattr(co, name, value)
    assert got(df.repartition(3), 2, 100) == brute(rows, 2, 100)


def test_quicksort_finds_every_frequent_prefix():
    rng = np.random.default_rng(1)
    columns = np.sort(rng.integers(1, 5, (5, 3000)).astype(np.int32), axis=0)
    columns[3:, rng.random(3000) < 0.3] = 0
    weights = rng.integers(1, 4, 3000)
    expected = Counter()
    for row, w in zip(columns.T.tolist(), weights.tolist(), strict=True):
        for k in range(2, 6):
            if row[k - 1]:
                expected[tuple(row[:k])] += w
    found = {tuple(columns[:n, r].tolist()): c for r, n, c in co.sorted_counts(columns, weights, 2, 50)}
    assert found == {p: c for p, c in expected.items() if c >= 50}


def test_score_passes_64_bits(spark):
    """a * n alone is over 2^63; the decimals stay exact."""
    a, n, le, ri = 4_000_000_019, 9_000_000_000_031, 4_000_000_021, 5_000_000_023
    row = spark.sql(f"""SELECT (CAST(1000 AS DECIMAL(4,0)) * CAST({a} AS DECIMAL(18,0)) * CAST({n} AS DECIMAL(18,0)))
        div (CAST({le} AS DECIMAL(18,0)) * CAST({ri} AS DECIMAL(18,0))) AS s""").first()
    assert row.s == 1000 * a * n // (le * ri)
