"""The lookups as SQL table functions beside the temporary views.

``register`` gives SQL text the parameterised queries that views cannot express:

    SELECT * FROM last_sessions(7, 5)
    SELECT * FROM user_sessions_between(7, TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-15')
    SELECT * FROM product_revenue(DATE '1996-01-01', DATE '1996-12-31') WHERE revenue > 1000

Each is a temporary SQL function over the views ``timeline`` and ``product_metrics``, so Spark plans
its body into the query: arguments reach the scan as pushed filters, and a query on top
of a function is optimised with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _columns(df: DataFrame, *names: str) -> str:
    """``name TYPE, ...`` of some columns (none: of all)."""
    kinds = dict(df.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in names or df.columns)


def register(timeline: DataFrame, metrics: DataFrame) -> list[str]:
    """Registers the views and functions in the session; returns the functions' names. ``timeline``: the flat
    timeline, computed or stored; ``metrics``: the daily metrics."""
    spark: SparkSession = timeline.sparkSession
    timeline.createOrReplaceTempView("timeline")
    metrics.createOrReplaceTempView("product_metrics")
    user = dict(timeline.dtypes)["user_id"]
    product = dict(metrics.dtypes)["product_id"]
    flat = ", ".join(f"`{c}`" for c in timeline.columns)
    daily = ", ".join(f"`{c}`" for c in metrics.columns)
    started = "CAST(session_info_start_time AS TIMESTAMP)"
    bodies = {
        # newest first: row keys of a user ascend from the newest session
        "last_sessions": (
            f"of_user {user}, n INT", _columns(timeline),
            f"""SELECT {flat} FROM (SELECT *, row_number() OVER (ORDER BY row_key) AS nth FROM timeline WHERE user_id = of_user)
                WHERE nth <= n"""),
        "user_sessions": (f"of_user {user}", _columns(timeline), f"SELECT {flat} FROM timeline WHERE user_id = of_user"),
        "user_sessions_between": (
            f"of_user {user}, first TIMESTAMP, until TIMESTAMP", _columns(timeline),
            f"SELECT {flat} FROM timeline WHERE user_id = of_user AND {started} >= first AND {started} < until"),
        "session_by_key": (
            "key STRING", _columns(timeline),
            f"""SELECT {flat} FROM timeline
                WHERE row_key = key AND user_id = try_cast(substring_index(key, '_', size(split(key, '_')) - 1) AS {user})"""),
        "converted_sessions": (
            f"of_user {user}", _columns(timeline),
            f"SELECT {flat} FROM timeline WHERE user_id = of_user AND behavior_conversion_status = 'converted'"),
        "product_days": (
            f"of_product {product}, first DATE, last DATE", _columns(metrics),
            f"SELECT {daily} FROM product_metrics WHERE product_id = of_product AND date BETWEEN first AND last"),
        "product_revenue": (
            "first DATE, last DATE", f"product_id {product}, revenue DOUBLE, days BIGINT",
            """SELECT product_id, CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE), count(*)
               FROM product_metrics WHERE date BETWEEN first AND last GROUP BY product_id"""),
    }
    for name, (arguments, result, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE({result}) RETURN {body}")
    return list(bodies)
