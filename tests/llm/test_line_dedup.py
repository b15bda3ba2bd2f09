from collections import defaultdict

import duckdb
from compare import compare
from llm_helpers import SF, check_oracle

from cartwheel.llm import line_dedup


def brute(rows, size=3):
    """(doc_id, text) -> (n_lines, n_removed, n_spans, kept text)."""
    docs = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    places = defaultdict(list)
    for d, (i, t) in enumerate(docs):
        full = [(n, x.strip(" \t\r")) for n, x in enumerate((t or "").split("\n")) if x.strip(" \t\r")]
        for k in range(len(full) - size + 1):
            places[tuple(x for _, x in full[k:k + size])].append((d, full[k][0], full[k + size - 1][0]))
    gone = defaultdict(set)
    for found in places.values():
        for d, a, b in sorted(found)[1:]:
            gone[d].update(range(a, b + 1))
    spans = defaultdict(set)
    for found in places.values():
        for d, a, b in sorted(found)[1:]:
            spans[d].add((a, b))
    out = {}
    for d, (i, t) in enumerate(docs):
        n = 0
        reach = -1
        for a, b in sorted(spans[d]):
            n += a > reach
            reach = max(reach, b)
        lines = (t or "").split("\n")
        kept = t if not gone[d] else "\n".join(x for k, x in enumerate(lines) if k not in gone[d])
        out[i, t] = (len(lines) if t else 0, len(gone[d]), n, kept)
    return out


def test_edge_cases(edge, rows):
    # ids 15 (twice) and 16 (two texts) are told apart by their texts
    expected = brute(rows)
    got = line_dedup.dedup_lines(edge).collect()
    assert len(got) == len(rows)
    want = sorted(((i, *expected[i, t]) for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert any(r.n_removed for r in got)


def test_carried_columns_and_emptied_documents(edge, rows):
    out = line_dedup.deduped(edge)
    assert out.columns == edge.columns
    kept = out.collect()
    assert {tuple(r)[0] for r in kept} >= {5, 6, 8}  # nothing was taken from null, empty and blank texts
    # 13 keeps its first line only: a window's later occurrences overlap the first one
    assert [tuple(r)[1] for r in kept if tuple(r)[0] == 13] == ["same line"]
    assert all(tuple(r)[4] == len(tuple(r)[1]) for r in kept if tuple(r)[1])


def test_emptied_document_goes(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "a\nb\nc"), (3, "x")], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in line_dedup.deduped(docs).collect()) == [1, 3]


def test_touching_windows_are_one_span(spark, scratch):
    rows = [(1, "a\nb\nc"), (2, "d\ne\nf"), (3, "a\nb\nc\nd\ne\nf"), (4, "a\nb\nc\nx\nd\ne\nf")]
    path = f"{scratch}/touching"
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    got = line_dedup.dedup_lines(docs)
    assert compare(got, con, line_dedup.OP1_SQL) == []
    assert {r.doc_id: r.n_spans for r in got.collect()} == {1: 0, 2: 0, 3: 1, 4: 2}


def test_empty_table(empty):
    assert line_dedup.dedup_lines(empty).count() == 0
    assert line_dedup.deduped(empty).columns == empty.columns


def test_oracle(spark):
    check_oracle(spark, "op1_line_dedup", SF)
