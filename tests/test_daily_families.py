"""Inventory family of the daily metrics, and distinct users from bitmaps."""

import datetime as dt
import random

import pytest

from cartwheel.operators import distinct_users as du
from cartwheel.operators import metrics
from cartwheel.plans.oracle import ORACLE
from cartwheel.plans.queries import QUERIES
from cartwheel.sources.catalog import Shop
from compare import compare, duck

SF = "/root/testdata/sf0.001"
DAY = dt.date(2026, 1, 1)


@pytest.fixture(scope="module")
def landed(spark, scratch):
    path = f"{scratch}/landed-families"
    Shop.from_testdata(spark, SF).land(path)
    return Shop.from_landed(spark, path).land_derived(path)


@pytest.mark.parametrize("name", ["product_metrics_all_families", "product_inventory_one_day", "product_unique_users_in_range",
                                  "unique_users_by_day", "product_daily_metrics", "sessions_by_keys"])
def test_stored_forms_match_the_oracle(landed, name):
    assert compare(QUERIES[name](landed), duck(SF), ORACLE[name]) == []


def test_every_stored_day_has_a_stock(landed):
    rows = landed.metrics
    assert rows.filter("stock_start is null or stock_end is null").count() == 0
    quiet = rows.filter("units_sold = 0")
    assert quiet.count() > 0 and quiet.filter("stock_start <> stock_end").count() == 0


def test_stock_is_carried_over_days_without_sales(spark):
    days = [(1, 0, 3), (1, 1, 0), (1, 5, 2), (1, 9, 0), (2, 3, 1), (3, 1, 4)]
    daily = spark.createDataFrame([(p, DAY + dt.timedelta(d), n) for p, d, n in days], "product_id int, date date, units_sold bigint")
    products = spark.createDataFrame([(1, 10), (2, 0), (4, 7)], "product_id int, current_stock int")
    got = {(r.product_id, (r.date - DAY).days): (r.stock_start, r.stock_end) for r in metrics.with_inventory(daily, products).collect()}
    assert got == {(1, 0): (15, 12), (1, 1): (12, 12), (1, 5): (12, 10), (1, 9): (10, 10), (2, 3): (1, 0), (3, 1): (None, None)}


def test_unknown_or_missing_families_are_errors(landed, spark):
    with pytest.raises(ValueError, match="no column family 'price'"):
        metrics.product_metrics_range(landed.metrics, "2024-01-01", "2024-01-02", families=("price",))
    plain = landed.metrics.drop("stock_start")
    with pytest.raises(ValueError, match="stock_start"):
        metrics.product_metrics_range(plain, "2024-01-01", "2024-01-02", families=("inventory",))


def sessions(spark, rows):
    """(user, [(product, day)]) as sessions."""
    data = [(u, [(f"{DAY + dt.timedelta(d)}T10:00:00", "product", p, None, 1) for p, d in views or []] if views is not None else None)
            for u, views in rows]
    view = "array<struct<timestamp:string,page_type:string,product_id:string,category_id:string,view_duration:int>>"
    return spark.createDataFrame(data, f"user_id string, page_views {view}")


def test_bitmaps_add_up_over_any_days(spark):
    rng = random.Random(2)
    rows = [(f"u{rng.randint(0, 60)}", [(f"p{rng.randint(0, 5) if k % 3 else 0}", rng.randint(0, 9)) for _ in range(rng.randint(0, 6))])
            for k in range(400)] + [(None, [("p0", 1)]), ("u1", [(None, 2)]), ("u2", None), ("u3", [])]
    bitmaps = du.daily_user_bitmaps(sessions(spark, rows)).cache()
    for a, b in ((0, 9), (3, 3), (2, 6), (20, 30)):
        start, end = DAY + dt.timedelta(a), DAY + dt.timedelta(b)
        expected = {}
        for u, views in rows:
            for p, d in views or []:
                if u is not None and p is not None and a <= d <= b:
                    expected.setdefault(p, (set(), set()))
                    expected[p][0].add(u)
                    expected[p][1].add(d)
        got = {r.product_id: (r.unique_users, r.days) for r in du.unique_users_in_range(bitmaps, str(start), str(end)).collect()}
        assert got == {p: (len(us), len(ds)) for p, (us, ds) in expected.items()}
    everyone = {u for u, views in rows for p, _ in views or [] if u and p}
    assert du.unique_users(bitmaps).first().unique_users == len(everyone)
    assert du.unique_users_in_range(bitmaps, "2026-01-01", "2026-01-09", "p3").count() == 1


def test_users_over_several_buckets(spark):
    users = spark.range(100_000).selectExpr("cast(id as string) user_id", "id as number")
    day = sessions(spark, [("0", [("p", 0)])]).drop("user_id").crossJoin(users.select("user_id"))
    bitmaps = du.daily_user_bitmaps(day, users)
    assert 4 <= bitmaps.count() <= 5  # 32,768 users to a bitmap
    assert du.unique_users(bitmaps, "product_id").collect()[0].unique_users == 100_000


def test_months_prune(landed):
    plan = du.unique_users_in_range(landed.user_bitmaps, "2024-01-08", "2024-01-15")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
