"""Array files: every split finds its elements, whatever it begins inside of; write -> read is whole."""

import json
import os
import random
import tempfile

import pytest

from cartwheel.sources import json_arrays as ja
from cartwheel.sources import json_source as js

SCHEMA = "id bigint, name string, tags array<string>, inner struct<a:string,b:array<struct<c:double>>>, m map<string,struct<q:int>>"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that every document spans some of them."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "300")
    spark.conf.set(names[1], "1")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def awkward(rng, k):
    piece = ["}", "{", "[", "]", ",", '"', "\\", "\\\\", '\\"', "}{", "é𝒳", "\n", "\t", "a b", "", "],[", "}],"]
    text = "".join(rng.choice(piece) for _ in range(rng.randint(0, 30)))
    return {"id": k, "name": text or None, "tags": [rng.choice(piece) for _ in range(rng.randint(0, 4))],
            "inner": {"a": text[::-1], "b": [{"c": rng.random()} for _ in range(rng.randint(0, 3))]} if k % 5 else None,
            "m": {rng.choice(piece) + str(j): {"q": j} for j in range(rng.randint(0, 3))}}


def write(text: str) -> str:
    folder = tempfile.mkdtemp(prefix="cartwheel-json-")
    path = os.path.join(folder, "docs.json")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def rows(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: (r["id"] is None, r["id"]))


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}])
def test_same_rows_as_json(spark, small_splits, style):
    rng = random.Random(str(style))
    docs = [awkward(rng, k) for k in range(200)]
    path = write(json.dumps(docs, **style))
    df = ja.read_arrays(spark, [path], SCHEMA)
    assert rows(df) == docs
    assert rows(df) == rows(spark.read.schema(SCHEMA).option("multiLine", "true").json(path))


def test_one_file_is_read_by_many_tasks(spark, small_splits):
    path = write(json.dumps([awkward(random.Random(1), k) for k in range(300)]))
    states = ja.split_states(ja.split_summaries(ja._scan(spark, [path]))).collect()
    assert len(states) > 50 and len({s.start for s in states}) == len(states)
    assert {s.state for s in states} == {0, 1}, "splits begin inside strings too"
    assert max(s.depth for s in states) > 2


def test_one_document_over_many_splits(spark, small_splits):
    docs = [{"id": 1, "name": "x}" * 5000}, {"id": 2, "name": ", " * 3000 + '"]'}, {"id": 3, "name": "n"}]
    got = rows(ja.read_arrays(spark, [write(json.dumps(docs))], "id bigint, name string"))
    assert got == docs


def test_several_files_and_empty_arrays(spark, small_splits):
    paths = [write(json.dumps([{"id": k, "name": f"f{k}}}"}])) for k in range(4)] + [write(" [ ]\n"), write("[]"), write("[" + " " * 900 + "]")]
    assert [r["id"] for r in rows(ja.read_arrays(spark, paths, "id bigint, name string"))] == [0, 1, 2, 3]
    assert ja.read_arrays(spark, [], "id bigint").count() == 0


GOOD = json.dumps([{"id": k, "name": "a" * 50} for k in range(40)])


@pytest.mark.parametrize("text", [
    GOOD[:-1], GOOD[:-40], GOOD[: len(GOOD) // 2], GOOD + "}", GOOD + " {}", GOOD + "]", GOOD + "[1]", GOOD[1:], "{" + GOOD,
    "[{}, , {}]", "[,{}]", "[{},]", '[{"id": 1}, 5]', '[{"id": 1}, null]', '[{"id": "x"}]', '["a"]', '[{"id": 1]', '[{"a": "}]',
    '{"id": 1}', "", " ", "[" + "," * 2000 + "]"])
def test_broken_files_are_errors(spark, small_splits, text):
    with pytest.raises(Exception):  # noqa: B017
        if not ja.holds_array(spark, write(text)):
            raise ValueError("not an array")
        ja.read_arrays(spark, [write(text)], "id bigint, name string").collect()


def test_permissive_reads_what_fits(spark):
    path = write('[{"id": 1}, {"id": "x"}, 5]')
    assert [r.id for r in ja.read_arrays(spark, [path], "id bigint", "PERMISSIVE").collect()] == [1, None, None]


@pytest.mark.parametrize("n, per_file, files", [(0, 10, 1), (1, 10, 1), (10, 10, 1), (11, 10, 2), (95, 10, 10)])
def test_write_and_read_back(spark, n, per_file, files):
    rng = random.Random(n)
    docs = [awkward(rng, k) for k in range(n)]
    df = spark.createDataFrame(docs, SCHEMA).coalesce(1)
    folder = tempfile.mkdtemp(prefix="cartwheel-json-")
    paths = ja.write_arrays(df, folder, "sessions", per_file)
    assert len(paths) == files and sorted(os.listdir(folder)) == sorted(
        x for p in paths for x in (os.path.basename(p), f".{os.path.basename(p)}.crc") if os.path.exists(os.path.join(folder, x)))
    held = []
    for p in paths:
        with open(p, encoding="utf-8") as f:
            text = f.read()
        assert "\n" not in text.strip() and len(json.loads(text)) <= per_file
        held += json.loads(text)
    assert sorted(held, key=lambda d: d["id"]) == docs
    assert rows(ja.read_arrays(spark, paths, SCHEMA)) == docs


def test_a_new_export_replaces_the_old_one(spark):
    folder = tempfile.mkdtemp(prefix="cartwheel-json-")
    df = spark.range(50).coalesce(1)
    assert len(ja.write_arrays(df, folder, "users", 10)) == 5
    assert len(ja.write_arrays(df.limit(5), folder, "users", 10)) == 1
    assert sorted(f for f in os.listdir(folder) if f.endswith(".json")) == ["users_0.json"]


def test_datasets_round_trip(spark):
    """The library's own reader reads what its writers write, in both layouts, and single files."""
    docs = spark.createDataFrame([(f"user_{k}", None, "2026-01-01", None) for k in range(30)], js.schemas.USERS)
    for layout, name in (("arrays", "users_0.json"), ("lines", "users_0.json")):
        folder = tempfile.mkdtemp(prefix="cartwheel-json-")
        js.write_dataset(docs, folder, "users", per_file=7, layout=layout)
        assert os.path.exists(os.path.join(folder, name))
        got = js.read_dataset(spark, folder, "users")
        assert got.schema == js.schemas.USERS
        assert sorted(got.collect()) == sorted(docs.collect())
    with open(os.path.join(folder, "users.json"), "w") as f:
        json.dump([{"user_id": "one more"}], f)
    assert js.read_dataset(spark, folder, "users").count() == 31

