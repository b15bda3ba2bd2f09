"""Sessions by inactivity gap: a user's views belong together while no pause is longer than the gap.

Sessions cut at midnight lose the time between the last view of a day and the first of
the next. Here Spark's ``session_window`` merges a user's views into sessions wherever they
fall, in each task first, so a user's views meet as partial sessions.

Defined cases: views without a user or time belong to no session; views at one time are
of one session, and a pause of exactly the gap does not end one; a session of one view
lasts 0 seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import array_fields

GAP = "30 minutes"


def views(sessions: DataFrame) -> DataFrame:
    """(user_id, ts, page_type, product_id), one row for each page view of stored sessions."""
    of_view = sessions.schema["page_views"].dataType.elementType["timestamp"].dataType.typeName()
    ts = F.try_to_timestamp("timestamp") if of_view == "string" else F.col("timestamp")
    pages = sessions.select("user_id", F.inline(array_fields("page_views", "timestamp", "page_type", "product_id")))
    return pages.select("user_id", ts.alias("ts"), "page_type", "product_id")


def sessions_by_gap(pages: DataFrame, gap: str = GAP) -> DataFrame:
    """Per session: user_id, session_start, session_end, duration_seconds, views, products (distinct),
    crosses_midnight. ``pages``: (user_id, ts, product_id)."""
    known = pages.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull())
    merged = known.groupBy("user_id", F.session_window("ts", gap)).agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count("*").alias("views"),
        F.size(F.collect_set("product_id")).cast("bigint").alias("products"))
    micros = F.timestamp_diff("MICROSECOND", "session_start", "session_end")
    return merged.select(
        "user_id", "session_start", "session_end", F.floor(micros / 1_000_000).alias("duration_seconds"), "views", "products",
        (F.to_date("session_start") != F.to_date("session_end")).alias("crosses_midnight"))
