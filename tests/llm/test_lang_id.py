import zlib

import pytest
from llm_helpers import SF
from pyspark.sql import functions as F

from cartwheel.llm import lang_id
from cartwheel.llm.queries import QUERIES


def test_number_signs_are_no_letters():
    for text in ("½ ²", "Ⅷ ³", "① 12 ٣", "1 2 3", "_ -", "\u0301"):
        assert lang_id.reduced(text) == b"" and lang_id.classify(text, {"en": None})[0] == "und", text
    assert lang_id.reduced("x² ½a É") == "x a é".encode()


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op3_lang_id"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got) and len(got) == len(truth)
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_language_source_and_id_are_no_inputs(spark, documents):
    changed = documents.selectExpr("doc_id + 0 AS doc_id", "text", "lang", "'other' AS source", "n_chars")
    a = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(documents).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(changed).collect()}
    assert a == b
    # held-out labels are never learned from
    wrong = documents.withColumn("lang", lang_id.F.when(lang_id.held_out(lang_id.F.col("doc_id")), "xx").otherwise(lang_id.F.col("lang")))
    assert {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(wrong).collect()} == a


def test_edge_cases(spark, edge, rows, documents):
    learned = lang_id.dictionaries(lang_id.sample(documents))
    assert set(learned) == {"de", "en", "es", "fr"}
    compressors = {k: lang_id._compressor(v) for k, v in learned.items()}
    for t in (None, "", " \n", "123 ... !!"):
        assert lang_id.classify(t, compressors) == ("und", 0.0, 0.0)
    got = lang_id.identify(edge).collect()
    assert len(got) == len(rows)
    assert {r.lang_pred for r in got if r.doc_id in (5, 6, 8)} == {"und"}
    assert all(r.held_out for r in got if r.doc_id is None)
    out = lang_id.identified(edge)
    assert out.columns == edge.columns and not {5, 6, 8} & {tuple(r)[0] for r in out.collect()}


def test_short_lines_and_shared_lines_are_learned(spark):
    learned = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    short = "kuu loistaa\nyö on pitkä\nlumi sataa hiljaa"
    shared = "bu satır her belgede aynı şekilde başlıyor ve uzun sürüyor"
    odd = "-" * 50 + "\n" + "12 " * 200 + "\nmae'r haul yn gwenu"
    rows = [(learned[0], short, "fi"), (learned[1], short + "\nvielä", "fi"), (learned[2], shared, "tr"), (learned[3], shared, "tr"),
            (learned[4], odd, "cy"), (learned[5], "ja", "xx"), (learned[6], "123 ...", "yy"), (learned[7], "月は\n明るい", "ja")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    lines = lang_id.sample(docs)
    assert lines["tr"] == [shared]
    assert set(lang_id.dictionaries(lines)) == {"fi", "tr", "cy", "xx", "ja"}
    assert all(len(ls[0]) <= lang_id.LINE_CHARS for ls in lines.values())
    got = {r.doc_id: r.lang_pred for r in lang_id.identify(docs).collect()}
    assert got[learned[0]] == "fi" and got[learned[2]] == "tr" and got[learned[7]] == "ja"


def test_no_labels_and_empty_table(spark, empty, edge):
    assert lang_id.identify(empty).count() == 0 and lang_id.identified(empty).count() == 0
    from pyspark.sql import functions as F

    from cartwheel.llm.common import take
    docs = take(edge, doc_id="bigint", text="string").withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lang_id.identify(docs).collect()} == {"und"}


@pytest.mark.parametrize("blocks", [1, 3])
def test_smallest_encoding_wins(blocks):
    content = {"a": b"abra kadabra simsalabim hokus pokus fidibus " * 20, "b": b"lorem ipsum dolor sit amet consectetur " * 20}
    compressors = {k: lang_id._compressor(v) for k, v in content.items()}
    text = "hokus pokus simsalabim abra fidibus " * 50 * blocks
    lang, score, margin = lang_id.classify(text, compressors)
    assert lang == "a" and score > 0.5 and margin > 0
    assert SF


def test_sample_is_that_of_a_plain_ranking(spark):
    docs = spark.range(20_000).selectExpr(
        "id doc_id", "concat('line of words for the document with number ', id % 9000) text", "if(id % 3 = 0, 'aa', 'bb') lang")
    got = lang_id.sample(docs, 100)
    learned = docs.filter("crc32(cast(string(doc_id) as binary)) % 5 <> 0")
    for lang in ("aa", "bb"):
        want = learned.filter(f"lang = '{lang}'").selectExpr("text line").distinct().orderBy(F.xxhash64("line"), "line").limit(100)
        assert got[lang] == [r.line for r in want.collect()]
