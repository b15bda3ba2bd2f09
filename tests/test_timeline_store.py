"""Batches of puts into the stored timeline, and lookups in it."""

import glob
import os
import random
import tempfile

import pytest

from cartwheel.operators import timeline_store as ts
from cartwheel.operators.timeline_store import TimelineStore

SCHEMA = "row_key string, user_id string, put_seq bigint, state string"


def puts(seed, n=400, users=30):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        user = f"user_{rng.randint(0, users)}" if k % 3 else "user_hot"
        out.append((f"{user}_{8293423422179 + rng.randint(0, 4)}", user, seed * 10_000 + rng.randint(0, n), f"s{k}"))
    return out


def last(rows):
    """The last put of each key, in plain Python."""
    out = {}
    for r in rows:
        if r[0] not in out or (r[2], r[3]) > (out[r[0]][2], out[r[0]][3]):
            out[r[0]] = r
    return sorted(out.values())


def new_path():
    return f"{tempfile.mkdtemp(prefix='cartwheel-store-')}/timeline"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(store):
    return sorted(tuple(r) for r in store.read().select("row_key", "user_id", "put_seq", "state").collect())


def files(store):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{store.rows_path}/slot=*/part-*")}


def test_batches_in_any_order_equal_one_load(spark):
    batches = [puts(k) for k in (2, 0, 1)]
    every = [r for b in batches for r in b]
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        store = TimelineStore.create(frame(spark, batches[order[0]]), new_path(), slots=8)
        for k in order[1:]:
            store.upsert(frame(spark, batches[k]))
        assert content(store) == last(every)


def test_a_repeated_batch_changes_nothing(spark):
    store = TimelineStore.create(frame(spark, puts(1)), new_path(), slots=4)
    before = content(store)
    store.upsert(frame(spark, puts(1)))
    assert content(store) == before


def test_untouched_folders_keep_their_files(spark):
    store = TimelineStore.create(frame(spark, puts(1)), new_path(), slots=16)
    before = files(store)
    touched = store.upsert(frame(spark, [("user_1_0000000000001", "user_1", 99_999, "new")]))
    after = files(store)
    assert len(touched) == 1

    def others(found):
        return {p: t for p, t in found.items() if f"slot={touched[0]}/" not in p}

    assert others(before) == others(after) and len(others(before)) > 5
    assert ("user_1_0000000000001", "user_1", 99_999, "new") in content(store)


def test_new_users_make_new_folders(spark):
    store = TimelineStore.create(frame(spark, []), new_path(), slots=8)
    with pytest.raises(Exception):  # noqa: B017
        store.read()  # a folder without files has no columns
    store = TimelineStore.create(frame(spark, puts(1)[:1]), new_path(), slots=64)
    store.upsert(frame(spark, puts(2)))
    store.upsert(frame(spark, []))
    assert content(store) == last(puts(1)[:1] + puts(2))


def test_other_columns_are_an_error(spark):
    store = TimelineStore.create(frame(spark, puts(1)), new_path(), slots=2)
    with pytest.raises(ValueError, match="more"):
        store.upsert(frame(spark, puts(1)).withColumnRenamed("state", "more"))


def test_the_layout_is_stored(spark):
    path = new_path()
    TimelineStore.create(frame(spark, puts(1)), path, slots=5)
    store = TimelineStore.open(spark, path)
    assert (store.slots, store.seq) == (5, "put_seq") and content(store) == last(puts(1))


def test_lookups_open_the_folder_of_their_user(spark):
    store = TimelineStore.create(frame(spark, puts(1)), new_path(), slots=16)
    rows = last(puts(1))
    df = store.of_user("user_hot")
    assert [r.row_key for r in df.collect()] == sorted(r[0] for r in rows if r[1] == "user_hot")
    assert "PartitionFilters: [isnotnull(slot" in df._jdf.queryExecution().toString()
    keys = [r[0] for r in rows[::7]] + ["user_none_1", "no key"]
    for got in (store.get(keys), store.get(spark.createDataFrame([(k,) for k in keys + keys], "k string"))):
        assert sorted(r.row_key for r in got.collect()) == sorted(r[0] for r in rows[::7])
    plan = store.get(keys[:1])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(slot" in plan and f"EqualTo(row_key,{keys[0]})" in plan
    assert store.get([]).count() == 0


def test_files_have_bloom_filters_of_the_keys(spark):
    rows = frame(spark, [(f"u{k}_{k}", f"u{k}", k, "s") for k in range(5000)])
    path = new_path()
    with_filter = TimelineStore.create(rows, path, slots=1)
    rows.withColumnRenamed("row_key", "other").coalesce(1).sortWithinPartitions("user_id", "other").write.parquet(f"{path}-plain")
    size = sum(os.path.getsize(p) for p in files(with_filter))
    plain = sum(os.path.getsize(p) for p in glob.glob(f"{path}-plain/part-*"))
    # some ten bits a key, and no megabyte for a small file
    assert plain + 5000 < size < plain + 200_000


def test_slots_hold_users_whole(spark):
    store = TimelineStore.create(frame(spark, puts(3)), new_path(), slots=8)
    assert store.stored().select("user_id", "slot").distinct().groupBy("user_id").count().filter("count > 1").count() == 0
    rows = store.stored()
    one = rows.select(ts.user_of_key(rows["row_key"]).alias("u"), "user_id")
    assert one.filter("u <> user_id").count() == 0
