"""Session queries: Q9, Q23, Q28, Q44, Q45, Q46.

A session document already holds its page views in one array, so per-view
derivations (duration to the next view, page-to-page transitions) are computed
inside the row with higher-order functions: no window, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import array_fields, parse_ts, safe_size, whole_seconds

FUNNEL_STAGES = ("Viewed Product", "Added to Cart", "Purchased")


def session_funnel(sessions_clean: DataFrame) -> DataFrame:
    """Per conversion status and device type: sessions, users, mean minutes,
    mean products viewed."""
    d = F.col("duration_seconds")
    nv = F.size("viewed_products")
    return (sessions_clean
            .groupBy("conversion_status", F.col("device_profile.type").alias("device_type"))
            .agg(F.count(F.lit(1)).alias("session_count"),
                 F.count_distinct("user_id").alias("unique_users"),
                 (F.try_divide(F.sum(d), F.count(d)) / F.lit(60.0)).alias("avg_duration_minutes"),
                 F.try_divide(F.sum(nv), F.count(nv)).alias("avg_products_viewed"))
            .select("conversion_status", "session_count", "unique_users",
                    "avg_duration_minutes", "avg_products_viewed", "device_type")
            .orderBy("conversion_status", F.desc("session_count"), "device_type"))


def _distinct_with_null(c: Column) -> Column:
    """COUNT(DISTINCT c) that also counts NULL as one value, like
    ``select(c).distinct().count()``."""
    return F.count_distinct(c) + F.max(c.isNull()).cast("int")


def conversion_funnel(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """(stage, users): distinct users who viewed a product, who had a
    non-empty cart, and who purchased.

    Sessions are first reduced to one row per user with two flags (partial
    aggregation, so a user with millions of sessions is one partial row per
    task); the stage counts are then plain conditional counts - no DISTINCT
    aggregate, no row duplication through Expand."""
    per_user = (sessions.groupBy("user_id")
                .agg(F.bool_or(safe_size("viewed_products") > 0).alias("viewed"),
                     F.bool_or(F.coalesce(F.size("cart_contents"), F.lit(0)) > 0).alias("carted"))
                .filter(F.col("user_id").isNotNull()))
    s = per_user.agg(F.count_if("viewed").alias("viewed"), F.count_if("carted").alias("carted"))
    t = transactions.agg(_distinct_with_null(F.col("user_id")).alias("purchased"))
    return (s.select(F.inline(F.array(
                F.struct(F.lit(FUNNEL_STAGES[0]).alias("stage"), F.col("viewed").alias("users")),
                F.struct(F.lit(FUNNEL_STAGES[1]).alias("stage"), F.col("carted").alias("users")))))
            .unionByName(t.select(F.lit(FUNNEL_STAGES[2]).alias("stage"),
                                  F.col("purchased").alias("users"))))


def funnel_conversion_rate(funnel: DataFrame) -> DataFrame:
    """Purchased / Viewed Product x 100 from a (stage, users) funnel."""
    users = lambda stage: F.max(F.when(F.col("stage") == stage, F.col("users")))
    return funnel.agg(
        users(FUNNEL_STAGES[0]).alias("viewed"),
        users(FUNNEL_STAGES[2]).alias("purchased"),
        (F.try_divide(users(FUNNEL_STAGES[2]).cast("double"), users(FUNNEL_STAGES[0]))
         * 100).alias("conversion_rate"))


def session_conversion_status(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Cart lines with quantity 0 are dropped; a session is converted when a
    transaction references it, abandoned when a cart was opened (even if every
    line had quantity 0), else browsed."""
    paid = (transactions.select("session_id").filter(F.col("session_id").isNotNull())
            .distinct().withColumn("paid", F.lit(True)))
    cart = F.map_filter("cart_contents", lambda k, v: v.quantity > 0)
    opened = F.coalesce(F.size("cart_contents"), F.lit(0)) > 0
    return (sessions.join(paid, "session_id", "left")
            .select("session_id", "user_id",
                    F.coalesce(F.size(cart), F.lit(0)).alias("cart_lines"),
                    F.when(F.col("paid"), F.lit("converted"))
                     .when(opened, F.lit("abandoned"))
                     .otherwise(F.lit("browsed")).alias("derived_status")))


def _sorted_views(sessions: DataFrame, *fields: str) -> Column:
    """Page views (only ``fields``, which include timestamp) in time order;
    the sort is stable, so equal times keep their order."""
    ts = "timestamp"
    pv = array_fields("page_views", *fields)
    if sessions.schema["page_views"].dataType.elementType[ts].dataType.typeName() == "string":
        pv = F.transform(pv, lambda x: x.withField(ts, F.try_to_timestamp(x[ts])))
    return F.array_sort(pv, lambda a, b: F.when(a[ts] < b[ts], -1)
                        .when(a[ts] > b[ts], 1).otherwise(0))


def page_view_durations(sessions: DataFrame) -> DataFrame:
    """Duration of each page view = next view's time - this time; the last
    view ends at the session end."""
    # the sorted array becomes a column first, so the per-element lambda reads
    # it by index instead of re-sorting it for every element
    df = sessions.select("session_id", parse_ts(sessions, "end_time").alias("end_t"),
                         _sorted_views(sessions, "timestamp", "page_type", "product_id").alias("sv"))
    sv = F.col("sv")
    with_next = F.transform(sv, lambda x, i: F.struct(
        (i + 1).alias("view_index"), x["timestamp"].alias("timestamp"),
        x["page_type"].alias("page_type"), x["product_id"].alias("product_id"),
        whole_seconds(x["timestamp"], F.coalesce(
            F.try_element_at(sv, i + 2)["timestamp"], F.col("end_t"))).alias("duration_seconds")))
    return df.select("session_id", F.inline(with_next))


def page_transitions(sessions: DataFrame) -> DataFrame:
    """Measured page-flow: count of page_type -> next page_type and its share
    among all transitions out of the same page type."""
    df = sessions.select(F.transform(_sorted_views(sessions, "timestamp", "page_type"),
                                     lambda x: x["page_type"]).alias("pt"))
    pt = F.col("pt")
    steps = F.transform(F.slice(pt, 2, F.greatest(F.size(pt) - 1, F.lit(0))),
                        lambda to, i: F.struct(F.element_at(pt, i + 1).alias("from_page"),
                                               to.alias("to_page")))
    counts = (df.select(F.inline(steps)).groupBy("from_page", "to_page")
              .agg(F.count(F.lit(1)).alias("transitions")))
    # the aggregated table has at most (#page types)^2 rows
    out_of = F.sum("transitions").over(Window.partitionBy("from_page"))
    return counts.select("from_page", "to_page", "transitions",
                         (F.col("transitions") / out_of).alias("share"))
