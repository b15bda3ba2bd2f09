"""Every registered query against its DuckDB oracle on the small test tables."""

import pytest

import __spark_entry__ as E
from cartwheel.plans.queries import LOOKUP_KEY, LOOKUP_USER, QUERIES
from compare import compare, duck, type_mismatches

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con_small, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert compare(df, con_small, E.oracle_sql()[name]) == []
    assert type_mismatches(df, con_small, E.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["bought_together", "product_performance", "user_behavior",
                                  "clv", "spending_summary", "user_sessions_flat",
                                  "product_daily_metrics", "session_by_key", "product_current_price"])
def test_query_matches_oracle_sf001(spark, name):
    df = E.queries()[name](spark, SF_MID)
    assert compare(df, duck(SF_MID), E.oracle_sql()[name]) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 20
    assert df.columns == ["product_id", "product_name", "base_price", "category_name",
                          "transactions", "quantity_sold", "revenue", "total_views",
                          "conversion_rate"]


def test_results_do_not_depend_on_callers_time_zone(spark, con_small):
    """Row keys use epoch millis; the entry points pin the session zone to UTC."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        for name in ("session_row_keys", "page_view_durations", "clean_sessions"):
            df = E.queries()[name](spark, SF_SMALL)
            assert compare(df, con_small, E.oracle_sql()[name]) == [], name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _rows(spark, name):
    return E.queries()[name](spark, SF_MID).collect()


def test_orders_match_their_totals_and_do_not(spark):
    assert {r.total_matches for r in _rows(spark, "order_totals")} == {True, False}


def test_orders_convert_sessions_and_do_not(spark):
    kinds = {r.derived_status for r in _rows(spark, "session_conversion_status")}
    assert kinds == {"converted", "abandoned", "browsed"}
    tx = E.Shop.from_testdata(spark, SF_MID).transactions.select("session_id")
    assert tx.filter("session_id is null").count() > 0
    sessions = E.Shop.from_testdata(spark, SF_MID).sessions.select("session_id")
    assert tx.filter("session_id is not null").join(sessions, "session_id", "left_anti").count() > 0


def test_stock_and_prices_are_there(spark):
    stock = _rows(spark, "product_daily_stock")
    assert all(r.stock_start == r.stock_end + r.units for r in stock) and len({r.stock_end - r.units_after for r in stock}) > 10
    prices = _rows(spark, "product_current_price")
    assert max(r.price_points for r in prices) > 1 and len({r.current_price for r in prices}) > 100


def test_puts_overwrite_each_other(spark):
    puts = E.Shop.from_testdata(spark, SF_MID).puts
    assert puts.count() > 2 * puts.select("row_key").distinct().count()


def test_lookups_find_their_user(spark):
    for name in ("last_sessions_one_user", "all_sessions_one_user", "converted_sessions_one_user", "session_by_key"):
        rows = _rows(spark, name)
        assert rows and {r.user_id for r in rows} == {LOOKUP_USER}, name
    assert [r.row_key for r in _rows(spark, "session_by_key")] == [LOOKUP_KEY]


@pytest.fixture(scope="module")
def landed(spark, scratch):
    path = f"{scratch}/landed-derived"
    E.Shop.from_testdata(spark, SF_SMALL).land(path)
    return E.Shop.from_landed(spark, path).land_derived(path)


@pytest.mark.parametrize("name", ["last_sessions_one_user", "session_by_key", "user_sessions_upsert", "product_daily_metrics",
                                  "product_metrics_range", "product_metrics_one_day", "product_revenue_in_range"])
def test_stored_forms_match_the_oracle(landed, con_small, name):
    assert compare(QUERIES[name](landed), con_small, E.oracle_sql()[name]) == []


def test_stored_forms_are_pruned(landed):
    plan = QUERIES["session_by_key"](landed)._jdf.queryExecution().toString()
    assert f"EqualTo(row_key,{LOOKUP_KEY})" in plan and f"EqualTo(user_id,{LOOKUP_USER})" in plan
    plan = QUERIES["product_metrics_one_day"](landed)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "date" in plan.split("PushedFilters")[1]
    plan = QUERIES["units_by_product"](landed)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<items:array<struct<product_id:bigint,quantity:int>>>" in plan
