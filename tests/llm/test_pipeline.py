"""Each stage, on what the one before kept, against its brute-force form; then the whole run."""

import corpus_pipeline as cp
import test_decontaminate
import test_line_dedup
import test_near_dup
import test_packing
from llm_helpers import SF

from cartwheel.llm import lang_id


def test_stages_and_run(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    contents = lang_id.dictionaries(lang_id.sample(docs))
    compressors = {k: lang_id._compressor(v) for k, v in contents.items()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    last = None
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        path = f"{scratch}/pipeline-{name}"
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name == "packing":
            test_packing.check(out.collect(), rows)
            last = out
            break
        assert out.columns == docs.columns
        if name == "lang_id":
            verdicts = [(r, lang_id.classify(r[1], compressors)) for r in rows]
            rows = [r for r, (lang, _, margin) in verdicts if lang != "und" and margin >= lang_id.MARGIN]
        elif name == "line_dedup":
            done = test_line_dedup.brute(rows)
            rows = [(i, done[i, t][3]) for i, t in rows if not done[i, t][1] or (done[i, t][3] or "").strip(" \t\r\n")]
        elif name == "near_dup":
            rows = [r for r, (i, _, c) in zip(rows, test_near_dup.brute(rows, 5, 80), strict=True) if i == c]
        else:
            bad = {b[0] for b in test_decontaminate.brute(rows, items) if b[5]}
            rows = [r for r in rows if r[0] not in bad]
        assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted(rows), name
        assert all(r.n_chars == len(r.text) for r in out.collect()), name
        docs = out
    whole = cp.run(spark, SF)
    pieces = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert pieces(whole) == pieces(last)
    assert cp.ORACLE_SQL is None and [n for n, _ in cp.STAGES] == ["lang_id", "line_dedup", "near_dup", "decontaminate", "packing"]
