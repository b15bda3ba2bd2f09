"""Distinct users that can be added up over days: bitmaps beside the daily metrics.

The unique users of two days cannot be summed, so each (product, day) keeps the set of
its users as bits. Users get whole numbers once; a number's bucket (32,768 numbers) and
place in it give the bit, one row for each product, day and bucket that has a user.
Any range of days, and any group of products, is the union of its rows' bitmaps
(``bitmap_or_agg``, combined in each task before the shuffle) and the count of their
bits, exactly, without going back to the sessions. A hot product is one row for each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import array_fields

BITMAP_COLUMNS = ("product_id", "date", "bucket", "users")


def user_numbers(sessions: DataFrame) -> DataFrame:
    """(user_id, number): a whole number for each user, close together inside a partition. Store it before it
    is used twice: the numbers are only fixed once written."""
    users = sessions.select("user_id").filter(F.col("user_id").isNotNull()).distinct()
    return users.withColumn("number", F.monotonically_increasing_id())


def daily_viewers(sessions: DataFrame) -> DataFrame:
    """(product_id, date, user_id), each once, by the day of the view."""
    stamp = sessions.schema["page_views"].dataType.elementType["timestamp"].dataType.typeName()
    day = F.to_date(F.try_to_timestamp("timestamp")) if stamp == "string" else F.to_date("timestamp")
    views = sessions.select("user_id", F.inline(array_fields("page_views", "product_id", "timestamp")))
    return views.filter(F.col("product_id").isNotNull() & F.col("user_id").isNotNull()).select(
        "product_id", day.alias("date"), "user_id").distinct()


def daily_user_bitmaps(sessions: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """``BITMAP_COLUMNS``: the users of each (product, day), by bucket of their numbers."""
    numbers = user_numbers(sessions) if numbers is None else numbers
    placed = daily_viewers(sessions).join(numbers, "user_id").select(
        "product_id", "date", F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit"))
    return placed.groupBy("product_id", "date", "bucket").agg(F.bitmap_construct_agg("bit").alias("users"))


def unique_users(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Distinct users of each group of columns ``by`` (none: of all) of stored bitmaps."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("users")).alias("n"))
    return merged.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unique_users"))


def in_range(bitmaps: DataFrame, start: str, end: str) -> DataFrame:
    """The days start to end, both included; a table stored by month is read by its months."""
    def month(day: str) -> int:
        return int(day[:4]) * 100 + int(day[5:7])

    days: Column = F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return bitmaps.filter(days & F.col("month").between(month(start), month(end)) if "month" in bitmaps.columns else days)


def unique_users_in_range(bitmaps: DataFrame, start: str, end: str, product_id=None) -> DataFrame:
    """(product_id, unique_users, days) over a range of days, for one product or all."""
    df = in_range(bitmaps, start, end)
    if product_id is not None:
        df = df.filter(F.col("product_id") == F.lit(product_id).cast(df.schema["product_id"].dataType))
    days = df.select("product_id", "date").distinct().groupBy("product_id").agg(F.count("date").alias("days"))
    return unique_users(df, "product_id").join(days, "product_id")
