"""Sessions by gap, interleaved layouts and SQL table functions."""

import datetime as dt
import random

import pytest

from cartwheel.functions import zorder
from cartwheel.operators import gap_sessions as gs
from cartwheel.operators import timeline
from cartwheel.plans.queries import LOOKUP_KEY, LOOKUP_USER, QUERIES, SESSION_RANGE
from cartwheel.sources import clustered, sql_functions
from cartwheel.sources.catalog import Shop
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
NOON = dt.datetime(2026, 1, 1, 12)


def plain_sessions(rows, gap):
    """[(user, start, end, views, products)] of (user, ts, product) rows, one view after the other."""
    out, held = [], {}
    for user, ts, product in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[0], r[1])):
        s = held.get(user)
        if s and ts - s[1] <= gap:
            s[1], s[2] = ts, s[2] + 1
        else:
            held[user] = s = [ts, ts, 1, set()]
            out.append((user, s))
        if product is not None:
            s[3].add(product)
    return sorted((u, s[0], s[1], s[2], len(s[3])) for u, s in out)


def test_sessions_by_gap(spark):
    rng = random.Random(4)
    rows = [(f"u{rng.randint(0, 5) if k % 3 else 0}", NOON + dt.timedelta(seconds=rng.randint(0, 5 * 86_400)), rng.choice([None, "a", "b"]))
            for k in range(600)]
    rows += [("edge", NOON, "a"), ("edge", NOON + dt.timedelta(minutes=30), "b"), ("edge", NOON + dt.timedelta(minutes=60, microseconds=1), "b"),
             ("night", dt.datetime(2026, 1, 1, 23, 59), "a"), ("night", dt.datetime(2026, 1, 2, 0, 1), "a"), (None, NOON, "a"), ("u1", None, "a"),
             ("same", NOON, "a"), ("same", NOON, "a")]
    df = spark.createDataFrame(rows, "user_id string, ts timestamp_ntz, product_id string").repartition(5)
    got = gs.sessions_by_gap(df).collect()
    assert sorted((r.user_id, r.session_start, r.session_end, r.views, r.products) for r in got) == plain_sessions(rows, dt.timedelta(minutes=30))
    night = [r for r in got if r.user_id == "night"]
    assert len(night) == 1 and night[0].crosses_midnight and night[0].duration_seconds == 120
    assert gs.sessions_by_gap(df.filter("false")).count() == 0


def test_given_sessions_cross_midnight(spark):
    got = QUERIES["sessions_by_gap"](Shop.from_testdata(spark, SF))
    assert got.filter("crosses_midnight").count() > 0


def test_interleaved_bits(spark):
    rng = random.Random(1)
    pairs = [(rng.getrandbits(16), rng.getrandbits(16)) for _ in range(200)] + [(0, 0), (65535, 65535)]

    def plain(x, y):
        return sum(((x >> k & 1) << (2 * k + 1)) | ((y >> k & 1) << (2 * k)) for k in range(16))

    df = spark.createDataFrame(pairs, "x bigint, y bigint").select("x", "y", zorder.interleaved(F.col("x"), F.col("y")).alias("z"))
    assert all(r.z == plain(r.x, r.y) for r in df.collect())
    row = spark.range(1).select(zorder.scaled(F.lit(None).cast("int"), 0, 1).alias("a"), zorder.scaled(F.lit(5), 0, 10).alias("b"),
                                zorder.scaled(F.lit(99), 0, 10).alias("c"), zorder.scaled(F.lit(3), 3, 3).alias("d"),
                                zorder.spread(F.lit(None).cast("string")).alias("e")).first()
    assert (row.a, row.b, row.c, row.d, row.e) == (0, 32768, 65535, 0, 0)


def test_both_columns_read_few_row_groups(spark, scratch):
    """Against the same rows sorted by one of the columns: that column alone reads few row groups."""
    start = dt.datetime(2026, 1, 1)
    df = spark.range(64_000).select(
        F.pmod(F.xxhash64("id"), F.lit(400)).alias("user_id"), (F.lit(start) + F.make_interval(mins=F.col("id"))).cast("timestamp_ntz").alias("ts"))
    both, one = f"{scratch}/by-both", f"{scratch}/by-user"
    clustered.write(df, both, "user_id", "ts", files=8, rows_in_group=250)
    df.repartitionByRange(8, "user_id").sortWithinPartitions("user_id", "ts").write.option("parquet.block.row.count.limit", 250).parquet(one)
    assert spark.read.parquet(both).exceptAll(df).count() == 0 and spark.read.parquet(both).count() == 64_000
    day = dt.datetime(2026, 1, 20)
    met, every = clustered.groups_read(spark, both, "ts", day, day + dt.timedelta(days=1))
    met_one, every_one = clustered.groups_read(spark, one, "ts", day, day + dt.timedelta(days=1))
    assert every >= 200 and met < 0.25 * every and met_one > 0.9 * every_one
    met, every = clustered.groups_read(spark, both, "user_id", 7, 7)
    assert met < 0.25 * every
    wanted = spark.read.parquet(both).filter("user_id = 7")
    assert wanted.count() == df.filter("user_id = 7").count()


def test_clustered_edge_cases(spark, scratch):
    schema = "user_id string, ts timestamp, d date"
    rows = [(None, None, None), ("a", NOON, NOON.date()), ("a", NOON, NOON.date()), (None, NOON, None)]
    for k, (data, time) in enumerate(((rows, "ts"), (rows, "d"), ([], "ts"), (rows[:1], "ts"))):
        path = f"{scratch}/clustered-{k}"
        clustered.write(spark.createDataFrame(data, schema), path, "user_id", time, files=2)
        assert sorted(spark.read.schema(schema).parquet(path).collect(), key=repr) == sorted(spark.createDataFrame(data, schema).collect(), key=repr)


@pytest.fixture(scope="module")
def shop(spark, scratch):
    path = f"{scratch}/landed-sql"
    Shop.from_testdata(spark, SF).land(path)
    return Shop.from_landed(spark, path).land_derived(path)


def test_table_functions_equal_the_operators(spark, shop):
    names = sql_functions.register(shop.timeline, shop.metrics.drop("month"))
    assert "last_sessions" in names
    flat = shop.timeline

    def same(sql, df):
        assert sorted(spark.sql(sql).collect(), key=repr) == sorted(df.collect(), key=repr), sql

    for n in (0, 1, 5, 1000):
        same(f"SELECT * FROM last_sessions({LOOKUP_USER}, {n})", timeline.last_sessions_for_user(flat, LOOKUP_USER, n))
    same(f"SELECT * FROM user_sessions({LOOKUP_USER})", timeline.all_sessions_for_user(flat, LOOKUP_USER))
    same(f"SELECT * FROM session_by_key('{LOOKUP_KEY}')", timeline.session_by_key(flat, LOOKUP_KEY))
    same("SELECT * FROM session_by_key('no key')", flat.limit(0))
    same(f"SELECT user_id, row_key, session_info_session_id, session_info_start_time, behavior_conversion_status "
         f"FROM converted_sessions({LOOKUP_USER})", timeline.converted_sessions_for_user(flat, LOOKUP_USER))
    a, b = SESSION_RANGE
    between = timeline.user_sessions_between(shop.sessions, a, b, LOOKUP_USER).select("row_key")
    same(f"SELECT row_key FROM user_sessions_between({LOOKUP_USER}, TIMESTAMP '{a}', TIMESTAMP '{b}')", between)
    same("SELECT count(*) FROM product_days(7, DATE '1996-01-01', DATE '1996-12-31')",
         shop.metrics.filter("product_id = 7 and year(date) = 1996").agg(F.count("*")))


def test_arguments_reach_the_scan(spark, shop):
    sql_functions.register(shop.timeline, shop.metrics)
    plan = spark.sql(f"SELECT session_info_referrer FROM user_sessions({LOOKUP_USER})")._jdf.queryExecution().toString()
    assert f"EqualTo(user_id,{LOOKUP_USER})" in plan
    assert "session_info_start_time" not in plan[plan.index("== Physical Plan =="):]
    plan = spark.sql("SELECT * FROM product_days(7, DATE '1996-01-01', DATE '1996-12-31')")._jdf.queryExecution().toString()
    scan = plan[plan.rindex("PartitionFilters"):]
    assert "product_id" in scan and "date" in scan.split("PushedFilters")[1], scan
