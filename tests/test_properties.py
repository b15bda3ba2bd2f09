"""Cross-query properties on the sf0.01 test tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import baskets, clean, customers, products, sales
from cartwheel.plans.queries import QUERIES
from cartwheel.sources.catalog import Shop

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def shop(spark):
    return Shop.from_testdata(spark, SF)


def _total(df, c):
    return df.agg(F.sum(F.col(c).cast("decimal(38,2)")).alias("s")).first().s


def test_daily_and_customer_sums_equal_order_total(shop):
    grand = _total(shop.transactions, "total")
    assert _total(sales.sales_over_time(shop.transactions), "daily_sales") == grand
    assert _total(customers.customer_spending(shop.transactions), "total_spent") == grand


def test_segments_cover_every_user(shop):
    seg = QUERIES["segment_summary"](shop)
    assert seg.agg(F.sum("customers")).first()[0] == shop.users.count()


def test_report_removed_is_before_minus_after(shop):
    for r in QUERIES["cleaning_report"](shop).collect():
        assert r.removed == r.before - r.after


def test_compatible_spend_is_exact_times_sessions(shop):
    compat = {r.user_id: r for r in QUERIES["user_behavior"](shop).collect()}
    exact = {r.user_id: r for r in customers.user_behavior_exact(
        shop.users, clean.clean_transactions(shop.transactions),
        clean.clean_sessions(shop.sessions), n=None).collect()}
    for uid, r in compat.items():
        e = exact[uid]
        assert abs(r.total_spent - e.total_spent * max(1, r.total_sessions)) < 1e-6 * r.total_spent


def test_pairs_ordered_and_equal_to_self_join(shop):
    tc = clean.clean_transactions(shop.transactions)
    got = baskets.basket_pair_counts(tc.select("transaction_id", F.col("items.product_id").alias("ids")),
                                     "transaction_id", "ids", "n")
    assert got.filter(F.col("product_a") >= F.col("product_b")).count() == 0
    lines = tc.select("transaction_id", F.explode("items.product_id").alias("pid"))
    a, b = lines.alias("a"), lines.alias("b")
    join = (a.join(b, (F.col("a.transaction_id") == F.col("b.transaction_id"))
                   & (F.col("a.pid") < F.col("b.pid")))
            .groupBy(F.col("a.pid").alias("product_a"), F.col("b.pid").alias("product_b"))
            .agg(F.count(F.lit(1)).alias("n")))
    assert got.exceptAll(join).count() == 0 and join.exceptAll(got).count() == 0


def test_top10_is_prefix_of_units_by_product(shop):
    top = [(r.product_id, r.total_quantity_sold) for r in products.top_selling_products(shop.transactions).collect()]
    allp = [(r.product_id, r.units_sold) for r in products.units_by_product(shop.transactions).limit(10).collect()]
    assert top == allp


def test_exact_median_matches_numpy(spark):
    rng = np.random.default_rng(7)
    for n in (1, 2, 5, 1000, 2001):
        vals = np.round(rng.gamma(2.0, 50.0, n), 2)
        vals[: n // 3] = vals[0]                      # a hot value holding a third of the rows
        df = spark.createDataFrame([(float(v),) for v in vals], "v double")
        got = customers.exact_median(df, "v").first().median
        assert abs(got - float(np.median(vals))) < 1e-9, n


def test_histogram_counts_all_customers(shop):
    cs = customers.customer_spending(shop.transactions)
    h = customers.spending_histogram(cs).collect()
    assert len(h) == 50 and sum(r.customers for r in h) == cs.count()
    vals = np.array([r.total_spent for r in cs.collect()])
    want, _ = np.histogram(vals, bins=50)
    assert [r.customers for r in h] == list(want)


def test_stored_output_property_of_compatible_form(shop):
    """The reference's one stored result has, in every row,
    total_spent / avg_order_value = total_purchases x total_sessions."""
    rows = QUERIES["user_behavior"](shop).collect()
    assert 0 < len(rows) <= 20
    assert [r.total_spent for r in rows] == sorted((r.total_spent for r in rows), reverse=True)
    for r in rows:
        ratio = r.total_spent / r.avg_order_value
        assert abs(ratio - r.total_purchases * max(1, r.total_sessions)) < 1e-6


@pytest.mark.parametrize("vals,places", [
    ([0.001, 0.002, 0.004], 3), ([-5.25, -1.0, 3.0, 1e9], 2), ([7.0], 2), ([], 2), ([None, 2.0], 2), ([1.01] * 9 + [5.0] * 9, 2)])
def test_exact_median_of_any_values(spark, vals, places):
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    some = [v for v in vals if v is not None]
    assert customers.exact_median(df, "v", places).first().median == (float(np.median(some)) if some else None)


def test_median_and_histogram_run_no_job_when_built(spark, shop):
    spark.sparkContext.setJobGroup("build", "build")
    cs = customers.customer_spending(shop.transactions)
    customers.spending_summary(cs)
    customers.spending_histogram(cs)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0


def test_single_user_lookups_agree_with_all_user_forms(shop):
    from cartwheel.operators import timeline
    flat = timeline.user_sessions_flat(shop.sessions)
    uid = flat.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").first().user_id
    last = [r.row_key for r in timeline.last_sessions_for_user(flat, uid, 5).collect()]
    want = [r.row_key for r in timeline.last_sessions(flat, 5).filter(F.col("user_id") == uid)
            .orderBy("recency_rank").collect()]
    assert last == want and len(last) == 5
    every = timeline.all_sessions_for_user(flat, uid).collect()
    assert [r.row_key for r in every] == sorted(r.row_key for r in every)
    key = last[0]
    assert [r.row_key for r in timeline.session_by_key(flat, key).collect()] == [key]
    conv = timeline.converted_sessions_for_user(flat, uid).collect()
    assert all(r.behavior_conversion_status == "converted" and r.user_id == uid for r in conv)
    beh = timeline.user_session_behavior(flat, 10, uid)
    assert set(beh.columns) == {"row_key", "user_id", "recency_rank", *timeline.BEHAVIOR}
