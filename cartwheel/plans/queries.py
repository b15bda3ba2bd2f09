"""Named queries over a :class:`Shop`: the catalogue used by the entry
points, the benchmark and the tests.

Each query is ``fn(shop) -> DataFrame``. Registered results have flat scalar
columns named exactly like the oracle's (plans/oracle.py).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators import baskets, clean, clv, customers, distinct_users, gap_sessions, metrics, products, sales
from cartwheel.operators import sessions as sess
from cartwheel.operators import timeline
from cartwheel.operators.timeline_store import TimelineStore
from cartwheel.session import checkpoint_dir
from cartwheel.sources import checked, clustered, json_arrays, sql_functions
from cartwheel.sources.catalog import Shop
from cartwheel.streaming import daily, newest

# Parameters of the registered range queries (a range filter is the feature).
SESSION_RANGE = ("2024-01-08", "2024-01-15")
METRICS_RANGE = ("1996-01-01", "1996-12-31")
METRICS_DAY = "1996-07-15"
# The pause that ends a session of the registered query: the events of a day lie hours apart.
GAP = "8 hours"
ALL_DAYS = ("1995-01-01", "2024-12-31")
# Parameters of the registered lookups; the key is one of the user's in the sf0.01 tables.
LOOKUP_USER = 7
LOOKUP_KEY = "7_8293423422179"
LOOKUP_PRODUCT = 7

Query = Callable[[Shop], DataFrame]


def _tc(s: Shop) -> DataFrame:
    return clean.clean_transactions(s.transactions)


def _sc(s: Shop) -> DataFrame:
    return clean.clean_sessions(s.sessions)


def _pc(s: Shop) -> DataFrame:
    return clean.clean_products(s.products)


def _norm(s: Shop, default_quantity: int = 0, *fields: str) -> DataFrame:
    # document extracts are coerced with defaults before the CLV / chart queries
    return clean.normalize_transactions(s.transactions, default_quantity, fields or clean.LINE_FIELDS)


def _units(s: Shop) -> DataFrame:
    return products.units_by_product(_norm(s, 0, "product_id", "quantity"))


def _c360(s: Shop) -> DataFrame:
    # CLV reads the raw (uncleaned) sessions and the normalised transactions
    return clv.customer_360(s.users, _norm(s, 1), s.sessions)


def _flat(s: Shop) -> DataFrame:
    return timeline.user_sessions_flat(s.sessions) if s.timeline is None else s.timeline


def _puts(s: Shop) -> DataFrame:
    if s.puts is not None:
        return s.puts
    # documents of one source: the order they are read in
    return timeline.user_sessions_flat(s.sessions).withColumn("put_seq", F.monotonically_increasing_id())


def _metrics(s: Shop, start: str | None = None, end: str | None = None) -> DataFrame:
    """Daily product metrics from the table stored by month, where there is one: a range
    reads its months' folders only, and of them the row groups of its dates."""
    if s.metrics is None:
        return metrics.product_daily_metrics(s.sessions, s.transactions, start, end)
    if start is None:
        return s.metrics
    month = lambda day: int(day[:4]) * 100 + int(day[5:7])
    return s.metrics.filter(
        F.col("month").between(month(start), month(end))
        & F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def _all_metrics(s: Shop) -> DataFrame:
    """All days with all three families: the stock of a day depends on the days after it."""
    if s.metrics is not None:
        return s.metrics
    return metrics.with_inventory(metrics.product_daily_metrics(s.sessions, s.transactions), s.products)


def _bitmaps(s: Shop) -> DataFrame:
    return distinct_users.daily_user_bitmaps(s.sessions) if s.user_bitmaps is None else s.user_bitmaps


def _folder(s: Shop, name: str) -> str:
    return f"{checkpoint_dir(s.sessions.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _sessions_from_json(s: Shop) -> DataFrame:
    """The sessions exported as files of one JSON array each and read back by many tasks."""
    docs = s.sessions.withColumn("cart_contents", F.transform_keys("cart_contents", lambda k, v: k.cast("string")))
    paths = json_arrays.write_arrays(docs, _folder(s, "sessions-json"), "sessions")
    return json_arrays.read_arrays(docs.sparkSession, paths, docs.schema)


def _with_broken_records(s: Shop) -> dict[str, checked.Load]:
    """The datasets exported as JSON, some records broken on the way (ids that leave 3 divided by 10), and
    loaded again: transactions with a field of another kind, sessions that are no objects, products cut off."""
    is_broken = lambda c: F.pmod(c.try_cast("bigint"), F.lit(10)) == 3  # ids that are no numbers are not broken
    docs = {"transactions": s.transactions, "products": s.products,
            "sessions": s.sessions.withColumn("cart_contents", F.transform_keys("cart_contents", lambda k, v: k.cast("string")))}
    value = F.col("value")
    broken = {"transactions": (F.col("transaction_id"), F.regexp_replace(value, '"total":[^,}]*', '"total":{"sum":1}'), "arrays"),
              "sessions": (F.col("user_id"), F.lit("17"), "arrays"),
              "products": (F.col("product_id"), F.left(value, F.length(value) - 1), "lines")}
    out = {}
    for name, df in docs.items():
        key, bad, layout = broken[name]
        texts = df.select("*", is_broken(key).alias("_broken"))
        texts = texts.select("_broken", json_arrays.json_text(texts.columns).alias("value"))
        texts = texts.select(F.when(F.col("_broken"), bad).otherwise(value).alias("value"))
        folder = _folder(s, f"{name}-checked")
        paths = json_arrays.write_texts(texts, folder, name, layout=layout)
        out[name] = checked.load(checked.records(df.sparkSession, paths), df.schema, f"{folder}/loaded", checked.VALID[name]())
    return out


def _last_sessions_streamed(s: Shop) -> DataFrame:
    """The newest session states of each user, from the puts as a stream of files."""
    puts, folder = _puts(s), _folder(s, "puts-stream")
    half = max(2, puts.sparkSession.sparkContext.defaultParallelism)  # two micro-batches, each the work of all cores
    puts.repartition(2 * half).write.parquet(f"{folder}/in")
    stream = daily.read_stream(puts.sparkSession, f"{folder}/in", puts.schema, max_files_per_trigger=half)
    newest.start(newest.newest_stream(stream, 5), f"{folder}/out", f"{folder}/checkpoint", available_now=True).awaitTermination()
    return newest.newest(puts.sparkSession, f"{folder}/out", puts.schema, 5)


def _upserted(s: Shop) -> DataFrame:
    """All puts, in three batches that overlap in keys and come in no order of time."""
    puts = _puts(s)
    batches = [puts.filter(F.pmod(F.xxhash64("put_seq"), F.lit(3)) == k) for k in range(3)]
    store = TimelineStore.create(batches[0], _folder(s, "timeline"))
    for b in batches[1:]:
        store.upsert(b)
    return store.read()


def _sql_last_sessions(s: Shop) -> DataFrame:
    """SQL text over the table functions: the newest sessions of one user."""
    sql_functions.register(_flat(s), _metrics(s).select(*METRICS_COLUMNS))
    return s.sessions.sparkSession.sql(f"SELECT * FROM last_sessions({LOOKUP_USER}, 5)")


def _sql_revenue(s: Shop) -> DataFrame:
    sql_functions.register(_flat(s), _metrics(s).select(*METRICS_COLUMNS))
    return s.sessions.sparkSession.sql("SELECT * FROM product_revenue(DATE '{}', DATE '{}')".format(*METRICS_RANGE))


def _between_clustered(s: Shop) -> DataFrame:
    """A range of time over all users, from sessions stored in interleaved order of user and time."""
    folder = _folder(s, "sessions-clustered")
    clustered.write(s.sessions.select("user_id", "session_id", "start_time"), folder, "user_id", "start_time")
    return timeline.user_sessions_between(s.sessions.sparkSession.read.parquet(folder), *SESSION_RANGE)


def _newest_by_key(s: Shop) -> DataFrame:
    """A batch of gets, one key for each user, from the stored timeline."""
    flat = _flat(s)
    store = TimelineStore.create(flat, _folder(s, "timeline"), seq="session_info_end_time")
    return store.get(timeline.last_sessions(flat, 1).select("row_key"))


METRICS_COLUMNS = ("row_key", "product_id", "date", *metrics.VIEWS, *metrics.SALES)


QUERIES: dict[str, Query] = {
    # Q1-Q4 cleaning
    "clean_transactions": lambda s: _tc(s).select(
        "transaction_id", "user_id", "timestamp", "transaction_date", "total", "status",
        "payment_method", F.size("items.product_id").alias("n_items")),
    "clean_sessions": lambda s: _sc(s).select(
        "session_id", "user_id", "start_time", "end_time", "duration_seconds", "conversion_status",
        F.col("device_profile.type").alias("device_type"),
        F.size("viewed_products").alias("n_viewed")),
    "clean_products": lambda s: _pc(s).select("product_id", "name", "category_id", "base_price"),
    "cleaning_report": lambda s: clean.cleaning_report(s.transactions, s.sessions, s.products),
    # Q5-Q6 co-occurrence
    "bought_together": lambda s: baskets.bought_together(_tc(s), _pc(s)),
    "viewed_together": lambda s: baskets.viewed_together(_sc(s), _pc(s)),
    # Q7-Q9 SQL analytics
    "product_performance": lambda s: products.product_performance(_tc(s), _sc(s), _pc(s), s.categories),
    "user_behavior": lambda s: customers.user_behavior(s.users, _tc(s), _sc(s)),
    "user_behavior_exact": lambda s: customers.user_behavior_exact(s.users, _tc(s), _sc(s)),
    "session_funnel": lambda s: sess.session_funnel(_sc(s)),
    # Q10-Q13 document aggregations
    "top_selling_products": lambda s: products.top_selling_products(s.transactions),
    "most_viewed_products": lambda s: products.most_viewed_products(s.sessions),
    "revenue_by_category": lambda s: products.revenue_by_category(s.transactions, s.products),
    "user_segmentation": lambda s: customers.user_segmentation(s.transactions),
    # Q14-Q19 CLV
    "session_metrics": lambda s: clv.session_metrics(s.sessions),
    "transaction_metrics": lambda s: clv.transaction_metrics(_norm(s, 1)),
    "customer_360": _c360,
    "clv": lambda s: clv.clv(_c360(s)),
    "top_customers_by_clv": lambda s: clv.top_customers_by_clv(clv.clv(_c360(s))),
    "segment_summary": lambda s: clv.segment_summary(clv.clv(_c360(s))),
    # Q20-Q28 chart data and summaries
    "sales_over_time": lambda s: sales.sales_over_time(_norm(s)),
    "sales_summary": lambda s: sales.sales_summary(sales.sales_over_time(_norm(s))),
    "customer_spending": lambda s: customers.customer_spending(_norm(s)),
    "spending_summary": lambda s: customers.spending_summary(customers.customer_spending(_norm(s))),
    "spending_histogram": lambda s: customers.spending_histogram(
        customers.customer_spending(_norm(s))),
    "units_by_product": lambda s: _units(s),
    "top_products_15": lambda s: _units(s).limit(15),
    "best_product": lambda s: _units(s).limit(1),
    "conversion_funnel": lambda s: sess.conversion_funnel(s.sessions, _norm(s)),
    "funnel_conversion_rate": lambda s: sess.funnel_conversion_rate(
        sess.conversion_funnel(s.sessions, _norm(s))),
    # Q29-Q37 session timeline
    "session_row_keys": lambda s: timeline.session_row_keys(s.sessions),
    "user_sessions_flat": _flat,
    "user_sessions_upsert": lambda s: timeline.user_sessions_upsert(_puts(s), "put_seq"),
    "last_sessions": lambda s: timeline.last_sessions(_flat(s), 5),
    "all_sessions_for_user": lambda s: timeline.all_sessions_for_user(_flat(s)).select(
        "user_id", "row_key", "session_info_session_id", "session_info_start_time"),
    "user_sessions_between": lambda s: timeline.user_sessions_between(s.sessions, *SESSION_RANGE),
    "last_sessions_one_user": lambda s: timeline.last_sessions_for_user(_flat(s), LOOKUP_USER, 5),
    "all_sessions_one_user": lambda s: timeline.all_sessions_for_user(_flat(s), LOOKUP_USER).select(
        "user_id", "row_key", "session_info_session_id", "session_info_start_time"),
    "session_by_key": lambda s: timeline.session_by_key(_flat(s), LOOKUP_KEY),
    "user_sessions_by_batches": _upserted,
    "user_sessions_between_clustered": _between_clustered,
    "sessions_by_gap": lambda s: gap_sessions.sessions_by_gap(gap_sessions.views(s.sessions), GAP),
    "sql_last_sessions": _sql_last_sessions,
    "sql_product_revenue": _sql_revenue,
    "sessions_by_keys": _newest_by_key,
    "clean_sessions_from_json": lambda s: QUERIES["clean_sessions"](Shop(
        users=s.users, products=s.products, categories=s.categories, transactions=s.transactions, sessions=_sessions_from_json(s))),
    "load_report": lambda s: checked.report(s.sessions.sparkSession, _with_broken_records(s)),
    "last_sessions_streamed": _last_sessions_streamed,
    "user_session_behavior": lambda s: timeline.user_session_behavior(_flat(s), 10),
    "converted_sessions_for_user": lambda s: timeline.converted_sessions_for_user(_flat(s)),
    "converted_sessions_one_user": lambda s: timeline.converted_sessions_for_user(_flat(s), LOOKUP_USER),
    # Q38-Q41 daily product metrics
    "product_daily_metrics": lambda s: _metrics(s).select(*METRICS_COLUMNS),
    "product_metrics_range": lambda s: metrics.product_metrics_range(
        _metrics(s, *METRICS_RANGE), *METRICS_RANGE, families=("sales",)),
    "product_metrics_one_product": lambda s: metrics.product_metrics_range(
        _metrics(s, *METRICS_RANGE), *METRICS_RANGE, product_id=LOOKUP_PRODUCT),
    "product_metrics_one_day": lambda s: metrics.product_metrics_range(
        _metrics(s, METRICS_DAY, METRICS_DAY), METRICS_DAY, METRICS_DAY),
    "product_revenue_in_range": lambda s: metrics.product_revenue_in_range(
        _metrics(s, *METRICS_RANGE), *METRICS_RANGE),
    "product_metrics_all_families": lambda s: metrics.product_metrics_range(
        _all_metrics(s), *ALL_DAYS, families=("views", "sales", "inventory")),
    "product_inventory_one_day": lambda s: metrics.product_metrics_range(
        _all_metrics(s), METRICS_DAY, METRICS_DAY, families=("inventory",)),
    "product_unique_users_in_range": lambda s: distinct_users.unique_users_in_range(_bitmaps(s), *SESSION_RANGE),
    "unique_users_by_day": lambda s: distinct_users.unique_users(_bitmaps(s), "date"),
    "product_current_price": lambda s: products.product_current_price(
        s.products if s.prices is None else s.prices),
    "product_daily_stock": lambda s: metrics.product_daily_stock(s.products, s.transactions),
    # Q43-Q46 derived fields
    "order_totals": lambda s: sales.order_totals(s.transactions),
    "session_conversion_status": lambda s: sess.session_conversion_status(s.sessions, s.transactions),
    "page_view_durations": lambda s: sess.page_view_durations(s.sessions),
    "page_transitions": lambda s: sess.page_transitions(s.sessions),
}
