"""Customer lifetime value: Q14-Q19.

Per-user session and transaction aggregates are computed separately (each
with map-side partial aggregation) and joined to the users on ``user_id``.
Score arithmetic is done in exact decimals and rounded half-up to 2 places,
so results do not depend on binary floating point.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import MONEY, div_half_up, safe_size

# Fixed values of the CLV model.
W_SESSIONS = Decimal("0.3")
W_CONVERTED = Decimal("0.5")
W_PRODUCTS = Decimal("0.2")          # applied to products viewed / 100
FUTURE_FACTOR = Decimal("0.5")
VIP_CLV, VIP_ENGAGEMENT = 1000, 10
HIGH_CLV, HIGH_ENGAGEMENT = 500, 5
MEDIUM_CLV = 200

D2 = "decimal(38,2)"


def session_metrics(sessions: DataFrame) -> DataFrame:
    d = F.col("duration_seconds")
    converted = F.sum(F.when(F.col("conversion_status") == "converted", 1).otherwise(0))
    return (sessions.groupBy("user_id")
            .agg(F.count("session_id").alias("total_sessions"),
                 converted.alias("converted_sessions"),
                 F.try_divide(F.sum(d), F.count(d)).alias("avg_session_duration_sec"),
                 F.sum(safe_size("viewed_products")).alias("total_products_viewed"))
            .withColumn("conversion_rate",
                        div_half_up(F.col("converted_sessions") * 100, F.col("total_sessions"))))


def transaction_metrics(transactions: DataFrame) -> DataFrame:
    spent = F.sum(F.col("total").cast(MONEY))
    return (transactions.groupBy("user_id")
            .agg(F.count("transaction_id").alias("total_transactions"),
                 spent.cast("double").alias("total_spent"),
                 div_half_up(spent * 100, F.count("total") * 100).alias("avg_order_value")))


def customer_360(users: DataFrame, transactions: DataFrame, sessions: DataFrame) -> DataFrame:
    flat = users.select("user_id",
                        F.col("geo_data.state").alias("state"),
                        F.col("geo_data.city").alias("city"),
                        F.col("geo_data.country").alias("country"))
    return (flat.join(transaction_metrics(transactions), "user_id", "left")
            .join(session_metrics(sessions), "user_id", "left"))


def _dec(c: str):
    return F.coalesce(F.col(c).cast(D2), F.lit(0).cast(D2))


def clv(integrated: DataFrame) -> DataFrame:
    """Engagement score, predicted future value, total CLV and segment."""
    cnt = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(20,0)")
    engagement = F.round(cnt("total_sessions") * F.lit(W_SESSIONS)
                         + cnt("converted_sessions") * F.lit(W_CONVERTED)
                         + cnt("total_products_viewed") * F.lit(W_PRODUCTS / 100), 2)
    future = F.round(_dec("avg_order_value") * engagement * F.lit(FUTURE_FACTOR), 2)
    total = F.round(_dec("total_spent") + future, 2)
    eng, tot = F.col("engagement_score"), F.col("total_clv")
    segment = (F.when((tot > VIP_CLV) & (eng > VIP_ENGAGEMENT), F.lit("VIP"))
               .when((tot > HIGH_CLV) & (eng > HIGH_ENGAGEMENT), F.lit("High Value"))
               .when(tot > MEDIUM_CLV, F.lit("Medium Value"))
               .otherwise(F.lit("Low Value")))
    return (integrated
            .withColumn("engagement_score", engagement.cast("double"))
            .withColumn("predicted_future_value", future.cast("double"))
            .withColumn("total_clv", total.cast("double"))
            .withColumn("customer_segment", segment))


def top_customers_by_clv(clv_df: DataFrame, n: int = 20) -> DataFrame:
    return clv_df.orderBy(F.desc("total_clv"), "user_id").limit(n)


def segment_summary(clv_df: DataFrame) -> DataFrame:
    clv_cents = F.sum(F.col("total_clv").cast(D2) * 100)
    return (clv_df.groupBy("customer_segment")
            .agg(F.count("user_id").alias("customers"),
                 div_half_up(clv_cents, F.count("total_clv") * 100).alias("avg_clv"),
                 F.sum(F.col("total_spent").cast(D2)).cast("double").alias("historical_revenue"),
                 F.sum(F.col("predicted_future_value").cast(D2)).cast("double")
                  .alias("predicted_revenue")))
