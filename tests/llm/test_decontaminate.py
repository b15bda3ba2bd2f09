import re
from collections import Counter

from llm_helpers import SF, check_oracle

from cartwheel.llm import decontaminate as d
from cartwheel.llm.common import documents
from cartwheel.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def brute(rows, items, size=10):
    windows = {}
    for i, t in items:
        ws = words(t)
        for k in range(max(len(ws) - size + 1, 1) if ws else 0):
            windows.setdefault(tuple(ws[k:k + size]), set()).add(i)
    out = []
    for i, t in rows:
        ws, hit, found = words(t), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(ws) - n + 1):
                if tuple(ws[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(ws[k:k + n])]
        found -= {None}
        out.append((i, len(ws), len(hit), len(found), sorted(map(str, found)), bool(hit)))
    return sorted(out, key=repr)


def items_of(rows):
    texts = {i: t for i, t in rows}
    long = " ".join(texts[1].split()[10:40])
    return [(1, long), (2, texts[7]), (3, None), (4, ""), (5, "no such words stand in any text of them all"), (1, long),
            (6, " ".join(texts[9].split()[500:512])), (7, "Ünï, CÖDÉ? É"), (None, texts[4]), (8, "a B"), (9, "a b")]


def test_edge_cases(spark, edge, rows):
    items = items_of(rows)
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, Text string")
    got = d.contamination(edge, frame).drop("k", "h")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, items)


def test_shuffled_joins_give_the_same(spark, edge, rows, monkeypatch):
    monkeypatch.setattr(d, "BROADCAST_BYTES", 0)
    items = items_of(rows)
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    got = d.contamination(edge, frame).drop("k", "h")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, items)


def test_clean(spark, edge, rows):
    frame = spark.createDataFrame(items_of(rows), "item_id bigint, text string")
    out = d.clean(edge, frame)
    assert out.columns == edge.columns
    bad = {(r[0], t) for r, (i, t) in zip(brute(rows, items_of(rows)), sorted(rows, key=repr), strict=True) if r[5]}
    bad = {(i, t) for i, t in rows if brute([(i, t)], items_of(rows))[0][5]}
    assert sorted((tuple(r)[:2] for r in out.collect()), key=repr) == sorted((r for r in rows if r not in bad), key=repr)


def test_proximity(spark):
    docs = documents(spark.createDataFrame([
        (1, "alpha beta gamma delta"), (2, "alpha x beta gamma delta"), (3, "alpha x x x x x x beta gamma delta"), (4, "beta")],
        "doc_id bigint, text string"))
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id bigint, text string")
    index = d.build_index(docs, items, size=4)
    near = {r.k for r in d.proximity_matches(index, 1).collect()}
    assert near == {1, 2}
    assert {r.k for r in d.proximity_matches(index, 0).collect()} == {1}
    assert {r.doc_id for r in d.phrase_matches(docs, index).filter("size(hits) > 0").collect()} == {1}


def brute_near(rows, items, slop, size=10):
    counts = Counter(w for _, t in rows for w in words(t))
    windows = {}
    for i, t in items:
        ws = words(t)
        for k in range(max(len(ws) - size + 1, 1) if ws else 0):
            windows.setdefault(tuple(ws[k:k + size]), set()).add(i)
    out = []
    for i, t in rows:
        ws, hit, found = words(t), set(), set()
        for w, ids in windows.items():
            _, off, rarest = min((counts[x], j, x) for j, x in enumerate(w))
            for start in (p - off for p, x in enumerate(ws) if x == rarest):
                used = []
                for j, x in enumerate(w):
                    used += [p for p in range(max(start + j - slop, 0), min(start + j + slop + 1, len(ws))) if ws[p] == x and p not in used][:1]
                if len(used) == len(w):
                    hit.update(used)
                    found |= ids
        found -= {None}
        out.append((i, len(ws), len(hit), len(found), sorted(map(str, found)), bool(hit)))
    return sorted(out, key=repr)


def test_proximity_report(spark, rows):
    items = items_of(rows)
    texts = dict(rows)
    passage = texts[1].split()[10:40]
    broken = " ".join(w + (" inserted" if k % 8 == 4 else "") for k, w in enumerate(passage))
    extra = [(50, broken), (51, "b a"), (52, "a x x x b")]
    docs = spark.createDataFrame(rows + extra, "doc_id bigint, text string")
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    for slop in (0, 2):
        got = sorted((tuple(r) for r in d.proximity(docs, frame, slop).collect()), key=repr)
        assert got == brute_near(rows + extra, items, slop)
    near = {r[0]: r for r in got}
    assert "1" in near[50][4] and not brute([(50, broken)], items)[0][5]
    assert near[51][5] and not near[52][5]


def test_proximity_needs_every_word(spark):
    docs = documents(spark.createDataFrame([
        (1, "one two three four five six seven"), (2, "one two three w x y z"), (3, "one two x three four five six seven"),
        (4, "four five six seven seven seven five six"), (5, "a b a"), (6, "a b")], "doc_id bigint, text string"))
    items = spark.createDataFrame([(1, "one two three four five six seven"), (2, "a b a")], "item_id bigint, text string")
    index = d.build_index(docs, items)
    assert {r.k for r in d.proximity_matches(index, 1).collect()} == {1, 3, 5}


def test_empty_tables(spark, edge, empty):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "word")], "item_id bigint, text string")
    assert d.contamination(empty, some).count() == 0
    assert d.contamination(edge, none).filter("contaminated").count() == 0
    assert d.clean(edge, none).count() == edge.count()


def test_oracle(spark):
    check_oracle(spark, "op8_decontaminate", SF)


def test_proximity_query_holds_the_exact_one(spark):
    exact = {r.doc_id: r for r in QUERIES["op8_decontaminate"](spark, SF).collect()}
    near = QUERIES["op8_proximity"](spark, SF).collect()
    assert len(near) == len(exact)
    assert all(r.n_near >= exact[r.doc_id].n_hit and r.n_near_items >= exact[r.doc_id].n_items for r in near)
