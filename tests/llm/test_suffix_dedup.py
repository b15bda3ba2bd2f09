import hashlib
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from llm_helpers import prose

from cartwheel.llm import suffix_dedup as sd


def brute(rows, n=50):
    """(doc_id, bytes, removed, spans, digest) of each row, by looking at every string."""
    least, texts = {}, [(i, (t or "").encode()) for i, t in rows]
    order = lambda i: (i is None, i or 0)
    for i, b in texts:
        for k in range(len(b) - n + 1):
            s = b[k:k + n]
            if s not in least or order(i) < least[s]:
                least[s] = order(i)
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if least[b[k:k + n]] < order(i):
                gone[k:k + n] = b"\1" * n
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(docs):
    return sorted((tuple(r)[:5] for r in sd.dedup_substrings(docs).collect()), key=repr)


def test_edge_cases(edge, rows):
    assert run(edge) == brute(rows)


@pytest.mark.parametrize("block_bytes,segment", [(1 << 12, 1 << 10), (1 << 22, 1 << 8)])
def test_awkward_texts(spark, monkeypatch, block_bytes, segment):
    monkeypatch.setattr(sd, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(sd, "SEGMENT_BYTES", segment)
    rng = random.Random(5)
    shared = prose(rng, 60)
    rows = [(i, prose(rng, 30) + shared[i:i + 40 + i] + prose(rng, 20)) for i in range(40)]
    rows += [(100, "a" * 300), (101, "a" * 49), (102, "a" * 50), (103, "ab" * 100), (104, "ba" * 40), (105, "\0" * 120), (106, "\0" * 90),
             (107, "é" * 60), (108, "x" + "é" * 30), (109, shared), (110, shared[1:]), (111, shared[:50]), (112, shared[-50:]), (113, shared[:49])]
    rng.shuffle(rows)
    assert run(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)


def surroundings(rng, n, anchor):
    """Texts around one string: some bytes before and after it agree, in every length."""
    short = lambda k: "".join(rng.choice("ab") if rng.random() < 0.3 else "x" for _ in range(k))
    return [(i, short(rng.randrange(40)) + anchor + short(rng.randrange(40))) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize("hot", [200_000, 20])
@pytest.mark.parametrize("large", [256, 1])
def test_one_string_in_many_surroundings(spark, monkeypatch, hot, large):
    monkeypatch.setattr(sd, "BLOCK_BYTES", 1 << 12)
    monkeypatch.setattr(sd, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(sd, "LARGE", large)
    monkeypatch.setattr(sd, "ROWS", 64)
    rows = surroundings(random.Random(hot + large), 600, "twenty-four bytes of text that many share")
    rows += surroundings(random.Random(hot), 300, "0123456789abcdefghijklmn") + [(None, rows[0][1]), (10 ** 12, rows[1][1])]
    assert run(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)


def test_hot_anchor_memory():
    """A hundred thousand different contexts of one anchor in one part: some hundred bytes each."""
    rng = np.random.default_rng(3)
    m = rng.integers(97, 123, (100_000, sd.LENGTH + sd.REACH + 1)).astype(np.uint8)
    m[:, :sd.KMER] = 97
    m[:, sd.LENGTH], m[:, -1] = sd.LENGTH, sd.REACH - 1
    m[1::2, sd.KMER:-1] = m[::2, sd.KMER:-1]
    m[1::4, 40:sd.LENGTH] = 65  # half of the equal ones differ at the end
    m = m[np.lexsort(m[:, :sd.LENGTH][:, ::-1].T)]
    cut = [sd.front_coded(m[k::4], np.arange(len(m))[k::4]) for k in range(4)]
    frame = pd.DataFrame({"block": range(4), "part": 0, "data": cut})
    tracemalloc.start()
    out = sd._merge(frame)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    assert all(len(sd._unpack(d)[0]) == 25_000 for d in out["data"])


def test_a_document_longer_than_a_block(spark):
    rng = random.Random(8)
    long = prose(rng, 1_600_000)
    docs = spark.createDataFrame([(1, long), (2, "start " + long[5_000_000:5_000_400] + " end"), (3, None)], "doc_id bigint, text string")
    assert len(long) > 2 * sd.BLOCK_BYTES
    got = {r.doc_id: r for r in sd.dedup_substrings(docs, with_text=True).collect()}
    assert got[1].kept.decode()[:1000] == long[:1000] and got[2].n_removed >= 400 and got[2].n_spans == 1
    assert got[2].n_bytes == 410 and got[3].n_bytes == 0


def test_text_that_stays(spark):
    docs = spark.createDataFrame([(1, "x" * 10 + "the same sixty characters stand in both of these two documents."),
                                  (2, "the same sixty characters stand in both of these two documents." + "y")], "doc_id bigint, text string")
    got = {r.doc_id: bytes(r.kept) for r in sd.dedup_substrings(docs, with_text=True).collect()}
    assert got[2] == b"y" and len(got[1]) == 73


def test_empty_table(empty):
    assert sd.dedup_substrings(empty).count() == 0


def test_loser_tree_merges_front_coded_runs_in_order():
    rng = np.random.default_rng(2)
    runs, every = [], []
    for n in (0, 1, 40, 7, 300):
        m = np.zeros((n, sd.LENGTH + sd.REACH + 1), np.uint8)
        m[:, :sd.LENGTH] = rng.integers(97, 99, (n, sd.LENGTH))
        m[:, 5:sd.LENGTH] *= rng.integers(0, 2, (n, 1)).astype(np.uint8)
        m[:, sd.LENGTH] = sd.LENGTH
        m = m[np.lexsort(m[:, :sd.LENGTH][:, ::-1].T)] if n else m
        every += [bytes(r[:sd.LENGTH]) for r in m]
        runs.append(sd.Run(sd.front_coded(m, np.arange(n, dtype=np.int64))))
    got, last = [], None
    for w, shared in sd.merged(runs):
        s = runs[w].suffix
        if last is not None:
            assert s[:shared] == last[:shared] and (shared == sd.LENGTH or s[shared] != last[shared])
        got.append(s)
        last = s
    assert got == sorted(every)


def test_packed_arrays_round_trip():
    arrays = [np.arange(5, dtype=np.uint64) << np.uint64(40), np.zeros(0, np.int32), np.array([1, 255], np.uint8)]
    for a, b in zip(arrays, sd._unpack(sd._pack(*arrays)), strict=True):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
