"""Product-level queries: Q7, Q10-Q12, Q22, Q27, Q42.

Per-product aggregates explode the nested lines and aggregate with map-side
partial aggregation, so a hot product costs one partial row per task, not a
hot shuffle partition. "Number of distinct transactions per product" is a
COUNT(DISTINCT) beside the sums: Spark reduces to one row per (product,
transaction) first, which also spreads a hot product over the tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import array_fields, money_sum


def sale_lines(transactions: DataFrame, *keep: str) -> DataFrame:
    """One row per line item: transaction_id, product_id, quantity, subtotal."""
    return transactions.select("transaction_id", *keep, F.inline(array_fields("items", "product_id", "quantity", "subtotal")))


def product_sales(transactions_clean: DataFrame) -> DataFrame:
    return (sale_lines(transactions_clean).groupBy("product_id")
            .agg(F.count_distinct("transaction_id").alias("num_transactions"),
                 F.sum("quantity").alias("total_quantity_sold"),
                 money_sum("subtotal").alias("total_revenue")))


def product_views(sessions_clean: DataFrame) -> DataFrame:
    return (sessions_clean.select(F.explode("viewed_products").alias("product_id"))
            .groupBy("product_id").agg(F.count(F.lit(1)).alias("total_views")))


def product_performance(transactions_clean: DataFrame, sessions_clean: DataFrame,
                        products_clean: DataFrame, categories: DataFrame, n: int = 20) -> DataFrame:
    """Sales and views per product; products sold or viewed; top n by revenue.

    conversion_rate = transactions / views * 100, NULL for a viewed product
    that never sold, 0 for a sold product never viewed.
    """
    ps = product_sales(transactions_clean)
    pv = product_views(sessions_clean)
    cat = categories.select("category_id", F.col("name").alias("category_name"))
    p = products_clean.select("product_id", F.col("name").alias("product_name"),
                              "base_price", "category_id")
    joined = (p.join(ps, "product_id", "left").join(pv, "product_id", "left")
              .join(cat, "category_id", "left")
              .filter(F.col("total_revenue").isNotNull() | F.col("total_views").isNotNull()))
    return (joined.select(
        "product_id", "product_name", "base_price", "category_name",
        F.coalesce("num_transactions", F.lit(0)).alias("transactions"),
        F.coalesce("total_quantity_sold", F.lit(0)).alias("quantity_sold"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("revenue"),
        F.coalesce("total_views", F.lit(0)).alias("total_views"),
        F.when(F.col("total_views") > 0,
               F.col("num_transactions") / F.col("total_views") * 100)
         .otherwise(F.lit(0.0)).alias("conversion_rate"))
        .orderBy(F.desc("revenue"), "product_id").limit(n))


def units_by_product(transactions: DataFrame) -> DataFrame:
    """Units sold per product, all products, most sold first (a missing
    quantity counts as 0)."""
    return (transactions.select(F.inline(array_fields("items", "product_id", "quantity")))
            .groupBy("product_id")
            .agg(F.coalesce(F.sum(F.coalesce("quantity", F.lit(0))), F.lit(0)).alias("units_sold"))
            .orderBy(F.desc("units_sold"), "product_id"))


def top_selling_products(transactions: DataFrame, n: int = 10) -> DataFrame:
    return (transactions.select(F.inline(array_fields("items", "product_id", "quantity")))
            .groupBy("product_id")
            .agg(F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_quantity_sold"))
            .orderBy(F.desc("total_quantity_sold"), "product_id").limit(n))


def most_viewed_products(sessions: DataFrame, n: int = 10) -> DataFrame:
    return (sessions.select(F.explode("page_views.product_id").alias("product_id"))
            .filter(F.col("product_id").isNotNull())
            .groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("views"))
            .orderBy(F.desc("views"), "product_id").limit(n))


def revenue_by_category(transactions: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Line subtotals by the category of their product (inner lookup: lines
    of unknown products are dropped, duplicated product ids multiply)."""
    lines = transactions.select(F.inline(array_fields("items", "product_id", "subtotal")))
    # pre-aggregate per product before the lookup join: the join then moves
    # one row per product instead of one per line
    per_product = lines.groupBy("product_id").agg(
        F.sum(F.col("subtotal").cast("decimal(18,2)")).alias("rev"))
    return (per_product.join(products.select("product_id", "category_id"), "product_id")
            .groupBy("category_id")
            .agg(F.sum("rev").cast("double").alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), "category_id").limit(n))


def top_products(transactions: DataFrame, n: int = 15) -> DataFrame:
    """First n rows of :func:`units_by_product`."""
    return units_by_product(transactions).limit(n)


def best_product(transactions: DataFrame) -> DataFrame:
    return top_products(transactions, 1)


def product_current_price(products: DataFrame) -> DataFrame:
    """From each product's price history: the latest price (current price) and
    the first date (creation date). History arrays are per product document,
    so the sort is in-row."""
    hist = F.array_sort(F.filter("price_history", lambda h: h.date.isNotNull()),
                        lambda a, b: F.when(a.date < b.date, -1).when(a.date > b.date, 1).otherwise(0))
    return products.select(
        "product_id",
        F.try_element_at(hist, F.lit(-1)).price.alias("current_price"),
        F.try_element_at(hist, F.lit(1)).date.alias("first_price_date"),
        F.size(hist).alias("price_points"))
