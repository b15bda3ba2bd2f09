"""Per-user session timeline with newest-first row keys: Q29-Q37.

A row key is ``<user_id>_<13-digit reverse epoch millis>``, so sorting keys
ascending lists a user's sessions newest first. The flat table keeps the
three column groups as prefixed columns (``session_info_*``, ``device_info_*``,
``behavior_*``); selecting one group is plain column pruning.
:func:`write_timeline` stores it sorted by key, so a lookup by user or key reads
only the row groups whose min/max range covers it.

Every lookup has an all-users form (a filter or a per-user top-n window); the
per-user top-n uses ``row_number() <= n``, which Spark executes with a
partial per-task limit before the shuffle, so a user with a huge number of
sessions sends at most n rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import parse_ts, safe_size

# Fixed values of the key format.
REVERSE_BASE = 9999999999999
KEY_DIGITS = 13
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

SESSION_INFO = ["session_info_session_id", "session_info_start_time", "session_info_end_time",
                "session_info_duration", "session_info_referrer"]
DEVICE_INFO = ["device_info_type", "device_info_os", "device_info_browser", "device_info_city",
               "device_info_state", "device_info_country", "device_info_ip"]
BEHAVIOR = ["behavior_conversion_status", "behavior_viewed_products",
            "behavior_products_viewed_count", "behavior_page_views", "behavior_cart_contents"]
FAMILIES = {"session_info": SESSION_INFO, "device_info": DEVICE_INFO, "behavior": BEHAVIOR}


def reverse_timestamp(ts: Column) -> Column:
    """13-digit zero-padded (REVERSE_BASE - epoch millis); never truncated."""
    r = (F.lit(REVERSE_BASE) - F.unix_millis(ts.cast("timestamp"))).cast("string")
    return F.when(F.length(r) >= KEY_DIGITS, r).otherwise(F.lpad(r, KEY_DIGITS, "0"))


def row_key(user_id: Column, ts: Column) -> Column:
    return F.concat(user_id.cast("string"), F.lit("_"), reverse_timestamp(ts))


def session_row_keys(sessions: DataFrame) -> DataFrame:
    start = parse_ts(sessions, "start_time")
    return sessions.select(row_key(F.col("user_id"), start).alias("row_key"),
                           "user_id", "session_id", start.alias("start_time"))


def _text(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType.typeName()
    return F.col(c) if dt == "string" else F.date_format(F.col(c), TS_TEXT)


def user_sessions_flat(sessions: DataFrame) -> DataFrame:
    """One row per session: row key, user id and 17 text cells in 3 groups;
    arrays and the cart map as JSON text, a missing cart as ``{}``."""
    start = parse_ts(sessions, "start_time")
    pv_type = sessions.schema["page_views"].dataType.elementType["timestamp"].dataType.typeName()
    pv = F.col("page_views")
    if pv_type != "string":
        pv = F.transform(pv, lambda x: x.withField("timestamp", F.date_format(x["timestamp"], TS_TEXT)))
    keep_nulls = {"ignoreNullFields": "false"}
    return sessions.select(
        row_key(F.col("user_id"), start).alias("row_key"),
        "user_id",
        F.col("session_id").alias("session_info_session_id"),
        _text(sessions, "start_time").alias("session_info_start_time"),
        _text(sessions, "end_time").alias("session_info_end_time"),
        F.col("duration_seconds").cast("string").alias("session_info_duration"),
        F.col("referrer").alias("session_info_referrer"),
        F.col("device_profile.type").alias("device_info_type"),
        F.col("device_profile.os").alias("device_info_os"),
        F.col("device_profile.browser").alias("device_info_browser"),
        F.col("geo_data.city").alias("device_info_city"),
        F.col("geo_data.state").alias("device_info_state"),
        F.col("geo_data.country").alias("device_info_country"),
        F.col("geo_data.ip_address").alias("device_info_ip"),
        F.col("conversion_status").alias("behavior_conversion_status"),
        F.to_json(F.coalesce("viewed_products", F.array_compact(F.array(F.lit(None).cast(
            sessions.schema["viewed_products"].dataType.elementType))))).alias("behavior_viewed_products"),
        safe_size("viewed_products").cast("string").alias("behavior_products_viewed_count"),
        F.to_json(pv, keep_nulls).alias("behavior_page_views"),
        F.coalesce(F.to_json("cart_contents", keep_nulls), F.lit("{}")).alias("behavior_cart_contents"))


def user_sessions_upsert(puts: DataFrame, seq) -> DataFrame:
    """Put semantics: rows with the same row key overwrite each other; the one
    put last, by the ingest sequence ``seq``, wins (a rank limit that Spark
    applies in each task before the shuffle, so a hot key ships one row per task)."""
    newest = Window.partitionBy("row_key").orderBy(F.col(seq).desc())
    return (puts.withColumn("nth", F.row_number().over(newest))
            .filter(F.col("nth") == 1).drop("nth"))


def write_timeline(flat: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The flat timeline stored for key lookups: rows of a user together, sorted
    by row key in each file (a hot user is split over several sorted files)."""
    (flat.hint("rebalance", "user_id").sortWithinPartitions("user_id", "row_key")
     .write.mode(mode).parquet(path))


def select_families(flat: DataFrame, *families: str) -> DataFrame:
    """Column-group projection (row key, user id and the named groups only);
    on Parquet this is column pruning at the scan."""
    cols = [c for f in families for c in FAMILIES[f]]
    return flat.select("row_key", "user_id", *cols)


def _newest_first(df: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("row_key")
    return (df.withColumn("recency_rank", F.row_number().over(w))
            .filter(F.col("recency_rank") <= n))


def last_sessions(flat: DataFrame, n: int = 5) -> DataFrame:
    """Newest n sessions of every user."""
    return _newest_first(flat.select("user_id", "row_key", "session_info_session_id",
                                     "session_info_start_time", "device_info_type",
                                     "behavior_conversion_status"), n)


def _of_user(df: DataFrame, user_id) -> Column:
    # the parameter takes the column's type, so the column is compared as stored
    return F.col("user_id") == F.lit(user_id).cast(df.schema["user_id"].dataType)


def last_sessions_for_user(flat: DataFrame, user_id, n: int = 5) -> DataFrame:
    """Key-range scan [user_, user_~) with a limit: newest n sessions of one user."""
    return flat.filter(_of_user(flat, user_id)).orderBy("row_key").limit(n)


def all_sessions_for_user(flat: DataFrame, user_id=None) -> DataFrame:
    """All sessions of a user (all users when None), newest first."""
    df = flat if user_id is None else flat.filter(_of_user(flat, user_id))
    return df.orderBy("user_id", "row_key")


def user_sessions_between(sessions: DataFrame, start: str, end: str, user_id=None) -> DataFrame:
    """Sessions starting in [start, end), newest first per user."""
    st = parse_ts(sessions, "start_time")
    df = sessions.filter((st >= F.lit(start).cast(st_type(sessions)))
                         & (st < F.lit(end).cast(st_type(sessions))))
    if user_id is not None:
        df = df.filter(_of_user(df, user_id))
    return session_row_keys(df).orderBy("user_id", "row_key")


def st_type(sessions: DataFrame) -> str:
    t = sessions.schema["start_time"].dataType.typeName()
    return "timestamp_ntz" if t == "timestamp_ntz" else "timestamp"


def session_by_key(flat: DataFrame, key) -> DataFrame:
    """Point lookup of one row key; ``key`` may also be a one-column
    DataFrame of keys (a batch of gets). The user id is read off the key, so
    the scan gets a predicate on a stored column even where the key is computed."""
    if isinstance(key, DataFrame):
        return flat.join(key.toDF("row_key"), "row_key", "left_semi")
    user = F.lit(key.rsplit("_", 1)[0]).try_cast(flat.schema["user_id"].dataType)
    return flat.filter((F.col("user_id") == user) & (F.col("row_key") == F.lit(key)))


def user_session_behavior(flat: DataFrame, n: int = 10, user_id=None) -> DataFrame:
    """The behavior group only, newest n sessions per user."""
    df = select_families(flat, "behavior")
    if user_id is not None:
        df = df.filter(_of_user(df, user_id))
    return _newest_first(df, n)


def converted_sessions_for_user(flat: DataFrame, user_id=None) -> DataFrame:
    """Single-column value filter: behavior_conversion_status = converted."""
    df = flat.filter(F.col("behavior_conversion_status") == "converted")
    if user_id is not None:
        df = df.filter(_of_user(df, user_id))
    return df.select("user_id", "row_key", "session_info_session_id", "session_info_start_time",
                     "behavior_conversion_status")
