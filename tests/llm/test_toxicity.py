import random

import numpy as np
import pytest
from llm_helpers import prose
from pyspark.sql import functions as F

from cartwheel.llm import toxicity

INSULTS = ("grubnak", "felzor", "wampert")


def corpus(n=500):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        words = prose(rng, 60).split()
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(60)] = rng.choice(INSULTS) + rng.choice(("", "s", "ish"))
        docs.append((i, " ".join(words)))
        labels.append((i, rng.randint(0, 1), int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    return (spark.createDataFrame(docs, "doc_id bigint, text string"),
            spark.createDataFrame([r for r in labels if r[0] % 4], "doc_id bigint, quality int, toxic int"))


def test_held_out_documents(tables):
    docs, labels = tables
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    held = [i for i in got if i % 4 == 0]
    assert len(got) == 500 and all(0 <= r.p_toxic <= 1 and 0 <= r.p_low_quality <= 1 for r in got.values())
    assert sum(got[i].toxic == (i % 5 == 0) for i in held) / len(held) > 0.97


def test_earlier_categories_feed_later_ones():
    rng = np.random.default_rng(3)
    low = rng.integers(0, 2, 400)
    rows = [np.array([10 + int(x), 50], np.int32) for x in low]
    data = toxicity.pd.DataFrame({"doc_id": range(400), "toxic": low, "low_quality": low, "weight": 1.0, "f": [r.tobytes() for r in rows]})
    chain = toxicity.fit_chain(data)
    assert [len(m.earlier) for m in chain] == [0, 1, 2]
    assert chain[1].earlier[0] > 0
    p = toxicity.chain_probabilities(chain, rows[:50])
    assert ((p[:, 1] > 0.5) == (low[:50] == 1)).all()


def test_edge_cases(spark, edge, rows, tables):
    out = toxicity.score(edge, tables[1]).collect()
    assert len(out) == len(rows)
    assert all(r.p_toxic == 0 and not r.toxic for r in out if r.doc_id in (5, 6, 8))


def test_labels_of_one_kind_none_or_null(spark, edge, empty, tables):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.p_toxic for r in toxicity.score(edge, none).collect()} == {0.0}
    clean = tables[1].filter("toxic = 0")
    assert not toxicity.score(tables[0], clean).filter("toxic").count()
    nulls = tables[1].withColumn("toxic", F.lit(None).cast("int"))
    assert {r.p_toxic for r in toxicity.score(edge, nulls).collect()} == {0.0}
    assert toxicity.score(empty, tables[1]).count() == 0


def test_sample_is_that_of_a_plain_ranking(spark):
    labels = spark.range(30_000).selectExpr("id doc_id", "cast(id % 7 as int) quality", "cast(id % 10 = 0 as int) toxic")
    docs = labels.selectExpr("doc_id", "concat('word', doc_id) text")
    got = toxicity.sample(docs, labels, 500)
    want = {i for t in (0, 1) for (i,) in labels.filter(f"toxic = {t}").select("doc_id").orderBy(F.xxhash64("doc_id")).limit(500).collect()}
    assert set(got["doc_id"]) == want and len(got) == 1000
    assert sorted(set(got["weight"])) == [6.0, 54.0]
