"""Sales over time and order arithmetic: Q20, Q24, Q43."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import MONEY, array_fields, parse_ts


def sales_over_time(transactions: DataFrame) -> DataFrame:
    """Sum of order totals per calendar day."""
    return (transactions
            .groupBy(F.to_date(parse_ts(transactions, "timestamp")).alias("date"))
            .agg(F.sum(F.col("total").cast(MONEY)).cast("double").alias("daily_sales"))
            .orderBy("date"))


def sales_summary(daily: DataFrame) -> DataFrame:
    """Total sales and the mean of the daily sums (one row)."""
    total = F.sum(F.col("daily_sales").cast("decimal(38,2)"))
    return daily.agg(total.cast("double").alias("total_sales"),
                     F.try_divide(total.cast("double"), F.count("daily_sales"))
                      .alias("avg_daily_sales"),
                     F.count(F.lit(1)).alias("days"))


def order_totals(transactions: DataFrame) -> DataFrame:
    """Recompute each order from its lines: line subtotal = round(qty x unit
    price, 2), subtotal = sum of lines, total = round(subtotal - discount, 2);
    compare with the stored values. All in-row (no shuffle)."""
    zero = F.lit(0).cast("decimal(38,2)")
    line = lambda x: F.round((x.quantity * x.unit_price).cast("decimal(38,10)"), 2).cast("decimal(38,2)")
    lines = array_fields("items", "quantity", "unit_price")    # reads 2 of the 4 line fields
    subtotal = F.coalesce(F.aggregate(lines, zero, lambda acc, x: (
        acc + F.coalesce(line(x), zero)).cast("decimal(38,2)")), zero)
    discount = F.coalesce(F.col("discount"), F.lit(0.0)).cast("decimal(38,10)")
    total = F.round(subtotal - discount, 2).cast("decimal(38,2)")
    return transactions.select(
        "transaction_id",
        subtotal.cast("double").alias("computed_subtotal"),
        total.cast("double").alias("computed_total"),
        F.col("subtotal").alias("stored_subtotal"),
        F.col("total").alias("stored_total"),
        (subtotal == F.col("subtotal").cast("decimal(38,2)")).alias("subtotal_matches"),
        (total == F.col("total").cast("decimal(38,2)")).alias("total_matches"))
