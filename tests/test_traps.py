"""Hand-made documents in the shop's JSON shape, one case per known trap
(SURVEY T1-T13, FIXTURES §4). Read through the JSON source, so the reader's
explicit schemas are exercised too."""

import os

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import baskets, clean, clv, customers, metrics, products, sales, timeline
from cartwheel.operators import sessions as sess
from cartwheel.session import checkpoint_dir
from cartwheel.sources.catalog import Shop
from conftest import write_json_array

GEO = {"city": "Springfield", "state": "CA", "country": "US"}


def _session(sid, uid, start, viewed, status="browsed", cart=None, end=None, page_views=None,
             duration=60):
    doc = {"session_id": sid, "user_id": uid, "start_time": start, "end_time": end or start,
           "duration_seconds": duration, "geo_data": {**GEO, "ip_address": "10.0.0.1"},
           "device_profile": {"type": "mobile", "os": "iOS", "browser": "Safari"},
           "viewed_products": viewed, "page_views": page_views or [],
           "conversion_status": status, "referrer": "direct"}
    if cart is not None:
        doc["cart_contents"] = cart
    return doc


def _txn(tid, uid, items, total, ts="2026-01-05T12:00:00", session_id=None):
    return {"transaction_id": tid, "session_id": session_id, "user_id": uid, "timestamp": ts,
            "items": items, "subtotal": total, "discount": 0, "total": total,
            "payment_method": "card", "status": "completed"}


def _item(pid, q, price):
    return {"product_id": pid, "quantity": q, "unit_price": price, "subtotal": round(q * price, 2)}


@pytest.fixture(scope="module")
def shop(spark, scratch):
    d = os.path.join(scratch, "shop_json")
    write_json_array(f"{d}/users.json", [
        {"user_id": u, "geo_data": GEO, "registration_date": "2025-01-01T00:00:00",
         "last_active": "2026-01-01T00:00:00"} for u in ("u1", "u2", "u3", "u4", "u5")])
    write_json_array(f"{d}/categories.json", [
        {"category_id": "c1", "name": "Books", "subcategories": []},
        {"category_id": "c2", "name": "Games", "subcategories": []}])
    write_json_array(f"{d}/products.json", [
        {"product_id": "p1", "name": "P1", "category_id": "c1", "base_price": 10.0},
        {"product_id": "p2", "name": "P2", "category_id": "c2", "base_price": 20},
        {"product_id": "p3", "name": "P3", "category_id": "c1", "base_price": 0},
        {"product_id": "p4", "name": "P4", "category_id": "c1", "base_price": -5.0},
        {"product_id": "p5", "name": "P5", "category_id": "c1", "base_price": None},
        {"product_id": "p6", "name": "P6", "category_id": "c1", "base_price": "abc"},
        {"product_id": "p7", "name": "P7", "category_id": "c2", "base_price": 7.5,
         "price_history": [{"price": 8.0, "date": "2025-03-01T00:00:00"},
                           {"price": 7.5, "date": "2025-06-01T00:00:00"},
                           {"price": 9.0, "date": "2025-01-01T00:00:00"}]}])
    write_json_array(f"{d}/transactions.json", [
        _txn("t1", "u1", [_item("p1", 1, 10.0), _item("p2", 2, 20.0)], 10.0),
        _txn("t2", "u1", [_item("p1", 1, 10.0), _item("p1", 1, 10.0), _item("p2", 1, 20.0)], 20.0,
             ts="2026-01-06T09:30:00"),
        _txn("t3", None, [_item("p1", 1, 10.0)], 10.0),
        _txn("t4", "u2", None, 10.0),
        _txn("t5", "u2", [], 10.0),
        _txn("t6", "u4", [_item("p1", 1, 5.0)], 5.0, session_id="s9"),
    ])
    write_json_array(f"{d}/sessions_0.json", [
        _session("s1", "u1", "2026-01-01T10:00:00Z", ["p7"], status="converted"),
        _session("s2", "u1", "2026-01-02T10:00:00Z", ["p7"]),
        _session("s3", "u1", "2026-01-03T10:00:00Z", ["p7"]),
        _session("s4", "u2", "2026-01-03T11:00:00Z", []),
        _session("s5", "u2", "2026-01-03T12:00:00Z", None),
    ])
    write_json_array(f"{d}/sessions_1.json", [
        _session("s6", "u5", "2026-01-04T10:00:00Z", ["p1"], cart={"p1": {"quantity": 0, "price": 10.0}},
                 status="abandoned"),
        _session("s7", "u5", "2026-01-04T10:00:00Z", ["p1"],
                 end="2026-01-04T10:00:30Z",
                 page_views=[{"timestamp": "2026-01-04T10:00:10Z", "page_type": "product_detail",
                              "product_id": "p2", "view_duration": 5},
                             {"timestamp": "2026-01-04T10:00:00Z", "page_type": "home",
                              "view_duration": 5}]),
        _session("s9", "u4", "2026-01-05T11:00:00Z", None,
                 cart={"p1": {"quantity": 1, "price": 5.0}}),
    ])
    return Shop.from_json(spark, d)


def test_json_array_file_reads_one_row_per_element(shop):
    assert shop.transactions.count() == 6
    assert shop.sessions.count() == 8                    # two files, one array each


def test_cart_is_a_map_not_a_struct(shop):
    dt = shop.sessions.schema["cart_contents"].dataType
    assert dt.typeName() == "map"


def test_cleaning_removes_bad_rows_and_reports(shop):
    tc = clean.clean_transactions(shop.transactions)
    assert sorted(r.transaction_id for r in tc.collect()) == ["t1", "t2", "t6"]
    assert dict(tc.dtypes)["timestamp"] == "timestamp"
    sc = clean.clean_sessions(shop.sessions)
    assert sorted(r.session_id for r in sc.collect()) == ["s1", "s2", "s3", "s6", "s7"]
    pc = clean.clean_products(shop.products)            # "abc", 0, -5, NULL: dropped, no error
    assert sorted(r.product_id for r in pc.collect()) == ["p1", "p2", "p7"]
    rep = {r.dataset: r for r in clean.cleaning_report(
        shop.transactions, shop.sessions, shop.products).collect()}
    assert (rep["transactions"].before, rep["transactions"].after, rep["transactions"].removed) == (6, 3, 3)
    assert (rep["sessions"].before, rep["sessions"].after) == (8, 5)
    assert (rep["products"].before, rep["products"].after, rep["products"].removed) == (7, 3, 4)


def test_pairs_bag_semantics(shop):
    tc = clean.clean_transactions(shop.transactions)
    pc = clean.clean_products(shop.products)
    rows = baskets.bought_together(tc, pc).collect()
    # t1 gives (p1,p2) once, t2 (p1 twice + p2) twice; t6 has one product: no pair
    assert [(r.product_a, r.product_b, r.bought_together_count) for r in rows] == [("p1", "p2", 3)]


@pytest.mark.parametrize("chunk", [1, 2, 64])
def test_pairs_equal_the_literal_self_join(spark, chunk):
    # a repeated basket id is one basket, a missing one joins nothing
    rows = [("b1", ["a", "b", "a", "c", None]), ("b2", ["c", "b"]), ("b3", ["x"]), ("b4", []), ("b5", None),
            ("b6", ["a", "a", "a", "b", "b"]), ("b2", ["c", "b"]), ("b1", ["d"]), (None, ["a", "b"]), (None, ["a", "b"])]
    df = spark.createDataFrame(rows, "bid string, ids array<string>")
    got = {(r.product_a, r.product_b): r.n for r in
           baskets.basket_pair_counts(df, "bid", "ids", "n", chunk_lines=chunk).collect()}
    lines = df.select("bid", F.explode("ids").alias("p"))
    want = {(r.x, r.y): r.n for r in lines.withColumnRenamed("p", "x").join(lines.withColumnRenamed("p", "y"), "bid")
            .filter("x < y").groupBy("x", "y").agg(F.count("*").alias("n")).collect()}
    assert got == want


def test_pairs_read_the_baskets_once(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("bid"), F.array(F.col("id"), F.col("id") + 1).alias("ids"))
    df.write.mode("overwrite").parquet(path := f"{checkpoint_dir(spark)}/pairs")
    out = baskets.basket_pair_counts(spark.read.parquet(path), "bid", "ids", "n")
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1 and final.count("FileScan parquet") == 1


def test_transactions_are_counted_distinct(spark):
    tx = spark.createDataFrame(
        [("t1", [("p", 1, 2.0, 2.0), ("p", 1, 2.0, 2.0)]), ("t1", [("p", 3, 2.0, 6.0)]), (None, [("p", 1, 2.0, 2.0)])],
        "transaction_id string, items array<struct<product_id:string,quantity:int,unit_price:double,subtotal:double>>")
    r = products.product_sales(tx).first()
    assert (r.num_transactions, r.total_quantity_sold, r.total_revenue) == (1, 6, 12.0)
    d = metrics.daily_sales(tx.withColumn("timestamp", F.lit("2026-01-01T10:00:00"))).first()
    assert (d.units_sold, d.num_transactions) == (6, 1)


def test_range_metrics_equal_the_full_ones_filtered(spark):
    views = "array<struct<timestamp:timestamp_ntz,product_id:string,view_duration:int>>"
    ss = spark.createDataFrame(
        [("s1", "u1", "2026-01-01 10:00:00", None, [("2026-01-02 10:00:00", "p", 5)]),
         ("s2", "u1", "2026-01-05 10:00:00", "2026-01-05 11:00:00", [("2026-01-02 09:00:00", "p", 7), ("2026-01-05 10:30:00", "p", 1)]),
         ("s2", "u2", None, "2026-01-01 00:00:00", [("2026-01-02 23:59:59", "p", None)])],
        "session_id string, user_id string, start_time string, end_time string, page_views array<struct<timestamp:string,product_id:string,view_duration:int>>",
    ).withColumn("page_views", F.col("page_views").cast(views))
    tx = spark.createDataFrame([], "transaction_id string, timestamp string, items array<struct<product_id:string,quantity:int,unit_price:double,subtotal:double>>")
    full = metrics.product_daily_metrics(ss, tx).filter("date = DATE '2026-01-02'").collect()
    part = metrics.product_daily_metrics(ss, tx, "2026-01-02", "2026-01-02").collect()
    assert full == part and len(part) == 1
    assert (part[0].view_count, part[0].unique_users, part[0].sessions_with_view, part[0].avg_view_duration) == (3, 2, 2, 6.0)


def test_conversion_rate_null_for_viewed_never_sold(shop):
    r = {x.product_id: x for x in products.product_performance(
        clean.clean_transactions(shop.transactions), clean.clean_sessions(shop.sessions),
        clean.clean_products(shop.products), shop.categories).collect()}
    assert r["p7"].conversion_rate is None and r["p7"].total_views == 3 and r["p7"].transactions == 0
    assert r["p2"].conversion_rate == 0.0 and r["p2"].total_views == 0
    assert r["p1"].transactions == 3 and r["p1"].quantity_sold == 4


def test_user_behavior_fan_out_and_exact(shop):
    tc, sc = clean.clean_transactions(shop.transactions), clean.clean_sessions(shop.sessions)
    compat = {r.user_id: r for r in customers.user_behavior(shop.users, tc, sc).collect()}
    exact = {r.user_id: r for r in customers.user_behavior_exact(shop.users, tc, sc).collect()}
    assert compat["u1"].total_spent == 90.0 and compat["u1"].avg_order_value == 15.0
    assert compat["u1"].total_sessions == 3 and compat["u1"].customer_segment == "Medium Value"
    assert exact["u1"].total_spent == 30.0
    assert compat["u4"].total_spent == 5.0            # orders, no session: not multiplied
    assert set(compat) == {"u1", "u4"}                 # HAVING purchases > 0


def test_user_behavior_matches_true_join(spark, shop):
    """The arithmetic form equals the literal LEFT JOIN x LEFT JOIN query."""
    clean.clean_transactions(shop.transactions).createOrReplaceTempView("tx_c")
    clean.clean_sessions(shop.sessions).createOrReplaceTempView("se_c")
    shop.users.createOrReplaceTempView("us")
    sql = spark.sql("""SELECT u.user_id, count(DISTINCT t.transaction_id) AS p,
                              sum(CAST(t.total AS decimal(18,2))) AS spent
                       FROM us u LEFT JOIN tx_c t ON u.user_id = t.user_id
                       LEFT JOIN se_c s ON u.user_id = s.user_id
                       GROUP BY u.user_id HAVING p > 0""")
    want = {r.user_id: float(r.spent) for r in sql.collect()}
    got = {r.user_id: r.total_spent for r in customers.user_behavior(
        shop.users, clean.clean_transactions(shop.transactions),
        clean.clean_sessions(shop.sessions), n=None).collect()}
    assert got == want


def test_clv_segments_and_strict_thresholds(spark):
    rows = [("a", 20, 8, 0, 0.0, 1000.0),     # engagement exactly 10, clv exactly 1000
            ("b", None, None, None, None, None),
            ("c", 40, 10, 100, 50.0, 2000.0)]
    df = spark.createDataFrame(rows, "user_id string, total_sessions long, converted_sessions long, "
                                     "total_products_viewed long, avg_order_value double, total_spent double")
    got = {r.user_id: r for r in clv.clv(df).collect()}
    assert got["a"].engagement_score == 10.0 and got["a"].total_clv == 1000.0
    assert got["a"].customer_segment == "High Value"        # not VIP: both comparisons strict
    assert (got["b"].engagement_score, got["b"].total_clv, got["b"].customer_segment) == (0.0, 0.0, "Low Value")
    # c: 40*.3 + 10*.5 + 100/100*.2 = 17.2; future = 50*17.2*.5 = 430; clv = 2430
    assert (got["c"].engagement_score, got["c"].predicted_future_value, got["c"].total_clv) == (17.2, 430.0, 2430.0)
    assert got["c"].customer_segment == "VIP"


def test_clv_user_without_activity_is_low_value(shop):
    c = {r.user_id: r for r in clv.clv(clv.customer_360(shop.users, shop.transactions, shop.sessions)).collect()}
    assert c["u3"].total_clv == 0.0 and c["u3"].customer_segment == "Low Value"
    assert c["u2"].total_sessions == 2                  # CLV reads raw sessions (s4, s5)


def test_half_up_rounding(spark):
    from cartwheel.functions.columns import div_half_up
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (-1, 8), (5, 0)], "n long, d long")
    got = [r.x for r in df.select(div_half_up(F.col("n") * 100, F.col("d")).alias("x")).collect()]
    assert got == [12.5, 33.33, 66.67, -12.5, None]
    rows = spark.createDataFrame([(1,), (1,), (0,), (0,), (0,), (0,), (0,), (0,)], "c int")
    # 2 converted of 8 -> 25.0; 1 of 8 would be 12.5 exactly (half-up, no binary error)
    assert rows.select(div_half_up(F.sum("c") * 100, F.count("c")).alias("x")).first().x == 25.0


def test_ansi_safe_size_and_division(shop):
    m = {r.user_id: r for r in clv.session_metrics(shop.sessions).collect()}
    assert m["u2"].total_products_viewed == 0           # [] and NULL count 0, not -1
    assert m["u1"].conversion_rate == 33.33


def test_top_k_tie_broken_by_key(spark):
    df = spark.createDataFrame([("t1", [("b", 2, 1.0, 2.0)]), ("t2", [("a", 2, 1.0, 2.0)])],
                               "transaction_id string, items array<struct<product_id:string,"
                               "quantity:int,unit_price:double,subtotal:double>>")
    assert [r.product_id for r in products.top_selling_products(df, 1).collect()] == ["a"]


def test_row_key_reverse_timestamp(shop):
    keys = {r.session_id: r.row_key for r in timeline.session_row_keys(shop.sessions).collect()}
    assert keys["s1"] == "u1_8232738399999"
    # newest first within a user
    assert keys["s3"] < keys["s2"] < keys["s1"]


def test_upsert_last_write_wins(shop):
    flat = timeline.user_sessions_flat(shop.sessions)
    up = timeline.user_sessions_upsert(flat.withColumn("seq", F.col("session_info_session_id")), "seq")
    rows = up.filter(F.col("user_id") == "u5").collect()
    assert len(rows) == 1 and rows[0].session_info_session_id == "s7"


def test_upsert_follows_the_ingest_order_not_the_values(spark):
    puts = spark.createDataFrame([("k", "zzz_first", 1), ("k", "aaa_second", 2), ("j", "x", 3)], "row_key string, v string, seq int")
    assert {r.row_key: r.v for r in timeline.user_sessions_upsert(puts, "seq").collect()} == {"k": "aaa_second", "j": "x"}


def test_flat_missing_cart_is_empty_json(shop):
    r = {x.session_info_session_id: x for x in timeline.user_sessions_flat(shop.sessions).collect()}
    assert r["s1"].behavior_cart_contents == "{}"
    assert r["s1"].behavior_viewed_products == '["p7"]'
    assert r["s5"].behavior_products_viewed_count == "0"


def test_cart_zero_quantity_dropped_status_abandoned(shop):
    got = {r.session_id: r for r in sess.session_conversion_status(shop.sessions, shop.transactions).collect()}
    assert got["s6"].cart_lines == 0 and got["s6"].derived_status == "abandoned"
    assert got["s9"].derived_status == "converted"      # a transaction references s9
    assert got["s1"].derived_status == "browsed"


def test_page_view_durations_sorted_and_last_ends_at_session_end(shop):
    rows = sess.page_view_durations(shop.sessions.filter(F.col("session_id") == "s7")).collect()
    assert [(r.page_type, r.duration_seconds) for r in rows] == [("home", 10), ("product_detail", 20)]


def test_order_totals_recomputed(shop):
    got = {r.transaction_id: r for r in sales.order_totals(shop.transactions).collect()}
    assert got["t1"].computed_subtotal == 50.0 and got["t1"].subtotal_matches is False
    assert got["t4"].computed_subtotal == 0.0


def test_current_price_from_history(shop):
    got = {r.product_id: r for r in products.product_current_price(shop.products).collect()}
    assert got["p7"].current_price == 7.5 and got["p7"].price_points == 3
    assert str(got["p7"].first_price_date).startswith("2025-01-01")
    assert got["p1"].current_price is None


def test_funnel_counts_distinct_users(shop):
    f = {r.stage: r.users for r in sess.conversion_funnel(shop.sessions, shop.transactions).collect()}
    # viewers u1, u5; carts u5 (s6, quantity 0 still an opened cart), u4; purchasers u1, u2, u4 + NULL
    assert f == {"Viewed Product": 2, "Added to Cart": 2, "Purchased": 4}


def test_daily_stock_from_final_stock(spark):
    prods = spark.createDataFrame([("p1", 10)], "product_id string, current_stock int")
    tx = spark.createDataFrame(
        [("2026-01-01T10:00:00", [("p1", 2, 1.0, 2.0)]), ("2026-01-03T10:00:00", [("p1", 3, 1.0, 3.0)])],
        "timestamp string, items array<struct<product_id:string,quantity:int,unit_price:double,subtotal:double>>")
    got = {str(r.date): (r.stock_start, r.stock_end) for r in metrics.product_daily_stock(prods, tx).collect()}
    assert got == {"2026-01-03": (13, 10), "2026-01-01": (15, 13)}


def test_normalize_transactions_defaults(spark):
    df = spark.createDataFrame(
        [("t1", None, [("p1", None, 2.5, 2.5)]), ("t2", 7.0, [("p2", 3, None, 9.0)])],
        "transaction_id string, total double, items array<struct<product_id:string,"
        "quantity:int,unit_price:double,subtotal:double>>").withColumn("discount", F.lit(None).cast("double"))
    got = {r.transaction_id: r for r in clean.normalize_transactions(df, default_quantity=1).collect()}
    assert got["t1"].total == 0.0 and got["t1"].discount == 0.0
    assert got["t1"].items[0].quantity == 1 and got["t1"].items[0].price == 2.5   # price <- unit_price
    assert got["t2"].items[0].quantity == 3 and got["t2"].items[0].price == 0.0
    zero_default = clean.normalize_transactions(df).collect()
    assert {r.transaction_id: r.items[0].quantity for r in zero_default}["t1"] == 0


def test_every_query_runs_on_json_documents(shop):
    """String ids and ISO-string timestamps (the documents' own types) go
    through every registered query."""
    from cartwheel.plans.queries import QUERIES
    failures = {}
    for name, q in QUERIES.items():
        try:
            q(shop).write.format("noop").mode("overwrite").save()
        except Exception as e:  # collect all failures for one report
            failures[name] = str(e).splitlines()[0][:200]
    assert failures == {}
