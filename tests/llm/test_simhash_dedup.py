import random
import re

import numpy as np
import pytest
import xxhash
from llm_helpers import SF, prose

from cartwheel.llm import simhash_dedup as sd
from cartwheel.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius=2):
    """The least id that links reach, by union-find over all pairs."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for r, i in enumerate(ids):
        if i is not None:
            least[find(r)] = min(i, least.get(find(r), i))
    return [least.get(find(r)) for r in range(len(ids))]


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    return sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(
        rows, fps, brute_components([i for i, _ in rows], fps), strict=True)), key=repr)


def got(df):
    return sorted(((r.doc_id, f"{r.fp % (1 << 64):016x}", r.component_id) for r in sd.near_duplicates(df).collect()), key=repr)


def test_query(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = QUERIES["op13_simhash_dedup"](spark, SF)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def test_edge_cases(edge, rows):
    assert got(edge) == expected(rows)


def test_empty(empty):
    assert got(empty) == []


def test_same_as_the_sql_function(spark):
    """Spark's own xxhash64 is XXH64 with seed 42."""
    assert spark.sql("SELECT xxhash64('ünï a b') AS h").first().h % (1 << 64) == xxhash.xxh64_intdigest("ünï a b".encode(), 42)


@pytest.mark.parametrize("words", [1, 2, 3, 4, 300, 5000])
def test_pieces_do_not_matter(words, monkeypatch):
    text = prose(random.Random(words), words).replace(" ", " \t\n", 3).title()
    whole = sd.fingerprint(text.encode(), 3)
    assert whole == plain_fingerprint(text)
    monkeypatch.setattr(sd, "PIECE_BYTES", 17)
    assert sd.fingerprint(text.encode(), 3) == whole


def family(rng, n, bits, steps):
    """Fingerprints a few random bits away from one another."""
    out = [rng.getrandbits(64)]
    while len(out) < n:
        x = rng.choice(out)
        for _ in range(rng.randint(1, steps)):
            x ^= 1 << rng.choice(bits)
        out.append(x)
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("group", [1024, 3])
def test_links_of_fingerprints(spark, group, monkeypatch):
    """Lone fingerprints, tight and loose families; with ``group`` 3 nearly all groups are dealt again."""
    monkeypatch.setattr(sd, "GROUP", group)
    monkeypatch.setattr(sd, "PAIRS", 64)
    rng = random.Random(group)
    fps = [rng.getrandbits(64) for _ in range(200)]
    for k in range(6):
        fps += family(rng, 40, rng.sample(range(64), 4 + 8 * k), 1 + k % 3)
    fps = list(dict.fromkeys(fps))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    table = sd.pivot_table(spark.createDataFrame([(x,) for x in signed], "fp bigint"))
    labels = {r.c: r.label for r in sd.components(sd.links(table, 2)).collect()}
    mine = [labels.get(x, x) for x in signed]
    assert mine == brute_components(signed, fps)


def test_pivot_rows_bound_the_distance(spark):
    rng = random.Random(4)
    fps = family(rng, 50, range(64), 4)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    rows = sd.pivot_table(spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect()
    d = {r.fp % (1 << 64): r.d for r in rows}
    assert all(d[x] == [(x ^ int(p)).bit_count() for p in sd.references()] for x in fps)
    for x in fps:
        for y in fps:
            assert max(abs(a - b) for a, b in zip(d[x], d[y], strict=True)) <= (x ^ y).bit_count()
