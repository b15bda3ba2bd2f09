"""Daily product metrics keyed ``<product_id>_<yyyyMMdd>``: Q38-Q41.

Views come from session page views (their own timestamps), sales from
transaction lines (the transaction's date). Each side is aggregated per
(product, day) with partial aggregation and the two sides are joined full
outer on the key; the per-product windows of Q41 then run over at most one
row per product and day, whatever the number of underlying sales.

Three column families: views, sales, and inventory (the stock at the start and end of
every stored day, also of days with views only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import MONEY, array_fields, parse_ts
from cartwheel.operators.products import sale_lines

VIEWS = ["view_count", "unique_users", "avg_view_duration", "sessions_with_view"]
SALES = ["units_sold", "revenue", "num_transactions", "avg_order_value", "conversion_rate"]
INVENTORY = ["stock_start", "stock_end"]
FAMILIES = {"views": VIEWS, "sales": SALES, "inventory": INVENTORY}


def _ts_range(df: DataFrame, ts_col: str, start: str, end: str):
    """start <= ts < end + 1 day as plain comparisons on the stored column, so
    the scan can skip files/row groups (a predicate on to_date(ts) could not)."""
    ts = parse_ts(df, ts_col)
    typ = "timestamp_ntz" if dict(df.dtypes)[ts_col] == "timestamp_ntz" else "timestamp"
    lo = F.lit(start).cast("date").cast(typ)
    hi = F.date_add(F.lit(end).cast("date"), 1).cast(typ)
    return (ts < hi) & (ts >= lo)


def daily_views(sessions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Per (product, day of the view). A range tests the views' own times only: a
    session's start and end may be missing, or lie elsewhere. Views are reduced to
    (product, day, session, user) before the two distinct counts."""
    pv_type = sessions.schema["page_views"].dataType.elementType["timestamp"].dataType.typeName()
    day = (lambda t: F.to_date(F.try_to_timestamp(t))) if pv_type == "string" else F.to_date
    views = sessions.select("session_id", "user_id", F.inline(
        array_fields("page_views", "product_id", "timestamp", "view_duration"))).select(
        "session_id", "user_id", "product_id", day(F.col("timestamp")).alias("date"), "view_duration",
    ).filter(F.col("product_id").isNotNull())
    if start is not None:
        views = views.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    once = views.groupBy("product_id", "date", "session_id", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("view_duration").alias("seconds"),
        F.count("view_duration").alias("timed"))
    return (once.groupBy("product_id", "date")
            .agg(F.sum("n").alias("view_count"),
                 F.count_distinct("user_id").alias("unique_users"),
                 F.try_divide(F.sum("seconds"), F.sum("timed")).alias("avg_view_duration"),
                 F.count_distinct("session_id").alias("sessions_with_view")))


def daily_sales(transactions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    if start is not None:
        transactions = transactions.filter(_ts_range(transactions, "timestamp", start, end))
    t = transactions.select("transaction_id", "items", F.to_date(parse_ts(transactions, "timestamp")).alias("date"))
    return (sale_lines(t, "date").groupBy("product_id", "date")
            .agg(F.sum("quantity").alias("units_sold"),
                 F.sum(F.col("subtotal").cast(MONEY)).alias("revenue_dec"),
                 F.count_distinct("transaction_id").alias("num_transactions")))


def product_daily_metrics(sessions: DataFrame, transactions: DataFrame,
                          start: str | None = None, end: str | None = None) -> DataFrame:
    """All (product, day) rows; with start/end (inclusive dates) both inputs
    are range-filtered before aggregating - a filter on the joined ``date``
    could not be pushed below the full outer join."""
    v, s = daily_views(sessions, start, end), daily_sales(transactions, start, end)
    j = v.join(s, ["product_id", "date"], "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return j.select(
        F.concat(F.col("product_id").cast("string"), F.lit("_"),
                 F.date_format("date", "yyyyMMdd")).alias("row_key"),
        "product_id", "date",
        zero("view_count").alias("view_count"), zero("unique_users").alias("unique_users"),
        "avg_view_duration", zero("sessions_with_view").alias("sessions_with_view"),
        zero("units_sold").alias("units_sold"),
        F.coalesce(F.col("revenue_dec"), F.lit(0).cast(MONEY)).cast("double").alias("revenue"),
        zero("num_transactions").alias("num_transactions"),
        F.try_divide(F.col("revenue_dec").cast("double"), F.col("num_transactions"))
         .alias("avg_order_value"),
        F.try_divide(F.col("num_transactions").cast("double"), F.col("view_count"))
         .alias("conversion_rate"))


def with_inventory(daily: DataFrame, products: DataFrame) -> DataFrame:
    """``daily`` (all days of each product) with the inventory family: the stock that the product's
    present one and the units sold on later days give. A day without sales carries the stock of
    the days around it. Null where the product is unknown. The window runs over one row for each
    day of a product."""
    later = Window.partitionBy("product_id").orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, -1)
    stock = products.select("product_id", "current_stock")
    end = F.col("current_stock") + F.coalesce(F.sum("units_sold").over(later), F.lit(0))
    return daily.join(stock, "product_id", "left").withColumn("stock_end", end).withColumn(
        "stock_start", F.col("stock_end") + F.col("units_sold")).drop("current_stock")


def product_metrics_range(metrics: DataFrame, start: str, end: str, product_id=None,
                          families=("views", "sales")) -> DataFrame:
    """Rows with start <= date <= end (one product or all), chosen families. A family that
    does not exist, or that ``metrics`` does not hold, is an error."""
    for f in families:
        if f not in FAMILIES:
            raise ValueError(f"no column family {f!r}: there are {', '.join(FAMILIES)}")
        if missing := [c for c in FAMILIES[f] if c not in metrics.columns]:
            raise ValueError(f"the metrics hold no {', '.join(missing)} (family {f!r}); see with_inventory")
    df = metrics.filter((F.col("date") >= F.lit(start).cast("date"))
                        & (F.col("date") <= F.lit(end).cast("date")))
    if product_id is not None:
        df = df.filter(F.col("product_id") == F.lit(product_id).cast(df.schema["product_id"].dataType))
    picked = [c for f in families for c in FAMILIES[f]]
    return df.select("row_key", "product_id", "date", *picked)


def product_revenue_in_range(metrics: DataFrame, start: str, end: str, product_id=None) -> DataFrame:
    df = product_metrics_range(metrics, start, end, product_id, families=("sales",))
    return (df.groupBy("product_id")
            .agg(F.sum(F.col("revenue").cast(MONEY)).cast("double").alias("revenue"),
                 F.count(F.lit(1)).alias("days")))


def product_daily_stock(products: DataFrame, transactions: DataFrame) -> DataFrame:
    """Stock at the start and end of each sales day, from the final stock:
    end(d) = current_stock + units sold after d; start(d) = end(d) + units on d.
    (Units of failed orders are not seen, so start is a lower bound.)"""
    lines = transactions.select(F.to_date(parse_ts(transactions, "timestamp")).alias("date"),
                                F.inline(array_fields("items", "product_id", "quantity")))
    s = lines.groupBy("product_id", "date").agg(
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("units"))
    after = F.sum("units").over(Window.partitionBy("product_id").orderBy(F.desc("date"))
                                .rowsBetween(Window.unboundedPreceding, -1))
    j = s.join(products.select("product_id", "current_stock"), "product_id")
    units_after = F.coalesce(after, F.lit(0))
    return j.select(
        "product_id", "date", "units",
        units_after.alias("units_after"),
        (F.col("current_stock") + units_after).alias("stock_end"),
        (F.col("current_stock") + units_after + F.col("units")).alias("stock_start"))
