import random
import re
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import prose
from llm_helpers import SF

from cartwheel.llm import near_dup as nd
from cartwheel.llm.common import documents as keyed
from cartwheel.llm.queries import QUERIES
from cartwheel.llm.shingles import WordHasher, shingle_hashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent):
    """Row number -> (set size, component's least id), by union-find over all pairs that share a shingle."""
    sets = [shingles(t, n) for _, t in rows]
    inside, parent = defaultdict(list), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for r, s in enumerate(sets):
        for x in s:
            inside[x].append(r)
    for r, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for q in inside[x]:
                common[q] += q > r
        for q, c in common.items():
            if c and 100 * c >= percent * (len(s) + len(sets[q]) - c):
                parent[find(q)] = find(r)
    least = defaultdict(lambda: None)
    for r, (i, _) in enumerate(rows):
        if i is not None and sets[r] and (least[find(r)] is None or i < least[find(r)]):
            least[find(r)] = i
    return [(i, len(sets[r]), least[find(r)] if sets[r] else i) for r, (i, _) in enumerate(rows)]


def test_edge_cases(edge, rows):
    for n, percent in ((3, 85), (5, 80)):
        got = nd.near_duplicates(keyed(edge), n, percent).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted((tuple(r) for r in got), key=repr) == sorted(brute(rows, n, percent), key=repr)


def test_query(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = QUERIES["op5_near_dup"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows, 3, 85))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert any(not r.kept for r in got)


def test_chain_of_neighbours(spark):
    # each text is near the next ones only: the links make one component
    rng = random.Random(3)
    words = prose(rng, 120).split()
    rows = []
    for i in range(40):
        words[(i * 7) % 120] = f"new{i}"
        rows.append((i, " ".join(words)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = nd.near_duplicates(keyed(docs), 3, 85).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 3, 85))


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(k, k + 1) for k in range(30)], [(0, k) for k in range(1, 30)], [(5, 4), (2, 9), (9, 4)]])
def test_components(spark, edges):
    got = {r.c: r.label for r in nd.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label


def test_deduped_keeps_one_of_each_group(edge, rows):
    out = nd.deduped(edge)
    assert out.columns == edge.columns
    kept = [tuple(r)[:2] for r in out.collect()]
    groups = {(c if t and t.split() else ("alone", i)) for (i, t), (_, _, c) in zip(rows, brute(rows, 5, 80), strict=True)}
    assert len(kept) == len(groups)
    assert {1, 4, 5, 6, 8, 9, 11, 15, 17} <= {i for i, _ in kept} and not {2, 3, 10, 18} & {i for i, _ in kept}


def test_empty_table(empty):
    assert nd.near_duplicates(keyed(empty)).count() == 0
    assert nd.deduped(empty).count() == 0


def test_signature_estimates_similarity():
    rng = random.Random(1)
    hasher = WordHasher()
    a = prose(rng, 2000).split()
    b = a[:1800] + prose(rng, 200).split()
    x, y = (np.unique(shingle_hashes(hasher.words(" ".join(w)), 5)) for w in (a, b))
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs((nd.signature(x, 500) == nd.signature(y, 500)).mean() - true) < 0.08


def test_word_hashes_are_those_of_the_words(monkeypatch):
    from cartwheel.llm import shingles as s

    text = "Aa bB\t\n\x0b cc É é x" + " yy" * 50
    whole = WordHasher().words(text)
    alone = [WordHasher().words(w)[0] for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    assert whole.tolist() == alone
    monkeypatch.setattr(s, "PIECE_BYTES", 16)
    assert WordHasher().words(text).tolist() == alone
    assert len(WordHasher().words("  ")) == len(WordHasher().words(None)) == 0


@pytest.mark.parametrize("block, values", [(1024, 4096), (7, 5), (1, 1)])
def test_similar_pairs_in_blocks(monkeypatch, block, values):
    monkeypatch.setattr(nd, "PRODUCT_ROWS", block)
    monkeypatch.setattr(nd, "PRODUCT_VALUES", values)
    rng = np.random.default_rng(4)
    x, y = ([np.unique(rng.integers(0, 30, rng.integers(1, 40))).astype(np.uint64) for _ in range(n)] for n in (20, 33))
    want = {(i, j) for i, a in enumerate(x) for j, b in enumerate(y)
            if 100 * len(np.intersect1d(a, b)) >= 70 * len(np.union1d(a, b))}
    got = [tuple(p) for p in nd.similar_pairs(x, y, 70).tolist()]
    assert want and len(got) == len(set(got)) and set(got) == want
    assert not len(nd.similar_pairs(x, [a + np.uint64(100) for a in y], 70))


def test_a_tile_of_templated_sets_takes_bounded_memory():
    import tracemalloc

    # five shingles that all share and three of their own: no link, much in common
    sets = [np.sort(np.array([*range(5), *(10 + 3 * k + np.arange(3))], np.uint64)) for k in range(8000)]
    tracemalloc.start()
    assert len(nd.similar_pairs(sets, sets[:4000], 85)) == 4000
    assert tracemalloc.get_traced_memory()[1] < 150e6
