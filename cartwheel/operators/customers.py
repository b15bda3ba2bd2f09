"""Customer-level queries: Q8 (both forms), Q13, Q21, Q25, Q26.

``user_behavior`` reproduces a users LEFT JOIN transactions LEFT JOIN
sessions query: every transaction row of a user is repeated once per session
row of that user, so SUM(total) is the true spend times the number of session
rows (when there is at least one); AVG and the DISTINCT counts are not
affected. Both forms here aggregate each side per user first and join the
per-user rows, so the cost is linear in the data instead of
orders x sessions per user; the compatible form applies the multiplier
arithmetically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import MONEY


def _segment_by_purchases(c="total_purchases"):
    return (F.when(F.col(c) >= 5, F.lit("High Value"))
            .when(F.col(c) >= 2, F.lit("Medium Value"))
            .otherwise(F.lit("Low Value")))


def _user_behavior(users: DataFrame, transactions_clean: DataFrame, sessions_clean: DataFrame,
                   n: int | None, fan_out: bool) -> DataFrame:
    t = transactions_clean.groupBy("user_id").agg(
        F.count_distinct("transaction_id").alias("total_purchases"),
        F.sum(F.col("total").cast(MONEY)).alias("spent"),
        F.count("total").alias("n_totals"))
    s = sessions_clean.groupBy("user_id").agg(
        F.count_distinct("session_id").alias("total_sessions"),
        F.count(F.lit(1)).alias("session_rows"))
    u = users.select("user_id", F.col("geo_data.state").alias("state"))
    # HAVING total_purchases > 0 keeps only users with a transaction: an inner
    # join with the per-user transaction rows says the same thing
    j = u.join(t, "user_id").join(s, "user_id", "left").filter(F.col("total_purchases") > 0)
    mult = (F.greatest(F.coalesce("session_rows", F.lit(0)), F.lit(1)) if fan_out
            else F.lit(1))
    spent = F.col("spent") * mult
    out = j.select(
        "user_id", "state", "total_purchases",
        spent.cast("double").alias("total_spent"),
        F.try_divide(spent.cast("double"), F.col("n_totals") * mult).alias("avg_order_value"),
        F.coalesce("total_sessions", F.lit(0)).alias("total_sessions"),
        _segment_by_purchases().alias("customer_segment"))
    out = out.orderBy(F.desc("total_spent"), "user_id")
    return out if n is None else out.limit(n)


def user_behavior(users, transactions_clean, sessions_clean, n: int | None = 20) -> DataFrame:
    """Reference-compatible: total_spent carries the join fan-out."""
    return _user_behavior(users, transactions_clean, sessions_clean, n, fan_out=True)


def user_behavior_exact(users, transactions_clean, sessions_clean, n: int | None = 20) -> DataFrame:
    """Same columns with the true spend per user."""
    return _user_behavior(users, transactions_clean, sessions_clean, n, fan_out=False)


def user_segmentation(transactions: DataFrame, n: int = 10) -> DataFrame:
    """Transactions and spend per user, most transactions first."""
    return (transactions.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("transactions_count"),
                 F.coalesce(F.sum(F.col("total").cast(MONEY)), F.lit(0).cast(MONEY))
                  .cast("double").alias("total_spent"))
            .orderBy(F.desc("transactions_count"), "user_id").limit(n))


def customer_spending(transactions: DataFrame) -> DataFrame:
    return (transactions.groupBy("user_id")
            .agg(F.sum(F.col("total").cast(MONEY)).cast("double").alias("total_spent")))


def exact_median(df: DataFrame, col: str, places: int = 2) -> DataFrame:
    """One row (median double): the mean of the two middle values, NULL without any.

    Values are whole multiples of 10^-places (money: cents), read as 64-bit
    integers. The bits of the range they really span are halved: values are counted
    by the upper half (map-side; at most 65,536 rows for a range below 2^32 units, the
    root of the range beyond), a running sum picks the rows that hold the middle ranks,
    and the values in these are counted by the lower half. Lazy: one plan, no value
    leaves the executors, two rounds at every size."""
    units = F.col(col).cast(f"decimal(38,{places})") * 10 ** places
    values = df.filter(F.col(col).isNotNull()).select(units.cast("bigint").alias("v"))
    span = values.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).select(
        F.struct("n", "low", F.expr("cast((length(bin(high - low)) + 1) div 2 as int)").alias("half")).alias("s")).scalar()
    split = values.withColumn("s", span).select(
        F.expr("shiftright(v - s.low, s.half)").alias("upper"),
        F.expr("(v - s.low) & (shiftleft(1L, s.half) - 1)").alias("lower"))

    def holding(counts: DataFrame, digit: str) -> DataFrame:
        """The rows whose run of ranks holds ``rank``, and the rank inside the run."""
        before = F.sum("n").over(Window.partitionBy("which").orderBy(digit)) - F.col("n")
        inside = counts.withColumn("rank", F.col("rank") - before)
        return inside.filter((F.col("rank") >= 0) & (F.col("rank") < F.col("n"))).drop("n")

    middle = F.expr("explode(array(struct(0 as which, (s.n - 1) div 2 as rank), struct(1 as which, s.n div 2 as rank)))")
    uppers = split.groupBy("upper").agg(F.count(F.lit(1)).alias("n")).withColumn("s", span)
    uppers = holding(uppers.select("upper", "n", middle.alias("r")).select("upper", "n", "r.which", "r.rank"), "upper")
    # the middle ranks lie in two rows at most
    lowers = split.join(F.broadcast(uppers), "upper").groupBy("which", "rank", "upper", "lower").agg(F.count(F.lit(1)).alias("n"))
    value = F.expr("cast(s.low + shiftleft(upper, s.half) + lower as decimal(38,0))")
    return holding(lowers, "lower").withColumn("s", span).agg(
        (F.sum(value).cast("double") / (2 * 10 ** places)).alias("median"))


def spending_summary(customer_spending_df: DataFrame) -> DataFrame:
    """Top spender (largest spend, then smallest id) and the median spend."""
    return customer_spending_df.agg(
        F.min_by("user_id", F.struct(-F.col("total_spent"), F.col("user_id"))).alias("top_user_id"),
        F.max("total_spent").alias("top_spent"),
        F.count("total_spent").alias("customers"),
    ).withColumn("median_spent", exact_median(customer_spending_df, "total_spent").scalar()).select(
        "top_user_id", "top_spent", "median_spent", "customers")


def spending_histogram(customer_spending_df: DataFrame, bins: int = 50) -> DataFrame:
    """Customers per equal-width spend bin over [min, max], the last bin closed
    (numpy/pandas rule; a single distinct value spreads the range by +-0.5, no
    value at all gives [0, 1]). The edges are a one-row aggregate inside the plan."""
    spark = customer_spending_df.sparkSession
    v = F.col("total_spent")
    stats = customer_spending_df.agg(F.min(v).alias("mn"), F.max(v).alias("mx"))
    spread = F.when(F.col("mn") == F.col("mx"), 0.5).otherwise(0.0)
    edges = stats.select(
        F.struct(F.coalesce(F.col("mn") - spread, F.lit(0.0)).alias("mn"),
                 F.coalesce(F.col("mx") + spread, F.lit(1.0)).alias("mx")).alias("e")).scalar()
    mn, width = F.col("e.mn"), (F.col("e.mx") - F.col("e.mn")) / bins
    b = F.least(F.floor((v - mn) * F.lit(float(bins)) / (F.col("e.mx") - mn)) + 1, F.lit(bins)).cast("int")
    counts = (customer_spending_df.filter(v.isNotNull()).withColumn("e", edges).groupBy(b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("customers")))
    numbers = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (numbers.join(counts, "bin", "left").withColumn("e", edges)
            .select("bin",
                    (mn + (F.col("bin") - 1) * width).alias("bin_start"),
                    (mn + F.col("bin") * width).alias("bin_end"),
                    F.coalesce("customers", F.lit(0)).alias("customers"))
            .orderBy("bin"))
