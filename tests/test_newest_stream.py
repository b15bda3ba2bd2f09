"""Any split of the puts into files and micro-batches, and a restart, give the batch answer."""

import datetime
import random
import tempfile

import pytest

from cartwheel.operators.timeline import _newest_first
from cartwheel.operators.timeline_store import last_puts
from cartwheel.streaming import daily, newest

SCHEMA = "row_key string, user_id bigint, put_seq bigint, at timestamp_ntz, note string"


def puts(rng, n):
    out = []
    for k in range(n):
        user = rng.choice([1, 1, 1, 2, 3, None])
        key = None if rng.random() < 0.02 else f"{user}_{rng.randrange(30):013d}"
        at = datetime.datetime(2024, 1, 1) + datetime.timedelta(microseconds=rng.randrange(10**12))
        out.append((key, user, None if rng.random() < 0.05 else rng.randrange(n // 4), at, rng.choice([None, "", "é", f"x{k}"])))
    return out


def batch(spark, rows, n):
    df = spark.createDataFrame([r for r in rows if r[0] is not None and r[1] is not None], SCHEMA)
    return sorted(_newest_first(last_puts(df, "put_seq"), n).collect(), key=repr)


def stream(spark, root, n, per_trigger):
    src = daily.read_stream(spark, f"{root}/in", spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=per_trigger)
    newest.start(newest.newest_stream(src, n, parts=3), f"{root}/out", f"{root}/ck", available_now=True).awaitTermination(120)
    return sorted(newest.newest(spark, f"{root}/out", src.schema, n).collect(), key=repr)


@pytest.mark.parametrize("files, per_trigger", [(1, 1), (5, 2)])
def test_splits_give_the_batch_answer_also_after_a_restart(spark, files, per_trigger):
    rng = random.Random(files)
    root = tempfile.mkdtemp(prefix="cartwheel-newest-")
    first, later = puts(rng, 200), puts(rng, 120)
    spark.createDataFrame(first, SCHEMA).repartition(files).write.mode("append").parquet(f"{root}/in")
    assert stream(spark, root, 4, per_trigger) == batch(spark, first, 4)
    # a query started again with the same checkpoint goes on from its lists
    spark.createDataFrame(later + first[:20], SCHEMA).repartition(files).write.mode("append").parquet(f"{root}/in")
    assert stream(spark, root, 4, per_trigger) == batch(spark, first + later, 4)


def test_a_list_holds_n_rows_and_only_changes_are_emitted():
    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    rows = lambda *r: newest.pd.DataFrame(r, columns=["row_key", "seq", "cells"])
    state, run = State(), newest._update(2)
    emitted = lambda *b: [tuple(x) for x in newest.pd.concat(run(("u", 0), iter(b), state)).itertuples(index=False)]
    assert emitted(rows(("c", 1, "x")), rows(("b", 2, "x"), ("a", 3, "x"), ("a", 1, "y"))) == [("u", "a", 3, "x"), ("u", "b", 2, "x")]
    assert emitted(rows(("c", 9, "late"), ("a", 2, "old"))) == []
    assert emitted(rows(("b", 4, "new"))) == [("u", "b", 4, "new")]
    assert [len(c) for c in state.get] == [2, 2, 2]


def test_before_the_first_micro_batch(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert newest.newest(spark, tempfile.mkdtemp() + "/none", schema, 3).count() == 0


def test_a_batch_is_reduced_to_lists_before_the_shuffle(spark):
    """A user with most puts sends n rows a batch, whatever the number of keys, and is one list."""
    assert newest.PARTS == 1
    rows = [("hot", f"hot_{k % 900:04d}", k, f"x{k}") for k in range(5000)]
    rows += [("hot", "hot_0003", 4503, "x9"), ("b", "b_1", 1, "x"), ("b", "b_1", -5, "z")]
    df = spark.createDataFrame(rows, "owner string, row_key string, seq bigint, cells string").coalesce(1)
    got = sorted(tuple(r) for r in newest.condensed(df, 4).collect())
    assert got == [("b", "b_1", 1, "x"), *(("hot", f"hot_{k:04d}", 4500 + k, f"x{9 if k == 3 else 4500 + k}") for k in range(4))]
