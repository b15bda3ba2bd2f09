"""Independent DuckDB SQL for every registered query (same column names).

Money is summed as DECIMAL(18,2) and ratios that are rounded use integer
division, mirroring the exact arithmetic of the Spark side, so results can be
compared value for value.
"""

from __future__ import annotations

from cartwheel.plans.oracle_base import CTES, with_ctes
from cartwheel.plans.queries import (
    LOOKUP_KEY,
    LOOKUP_PRODUCT,
    LOOKUP_USER,
    METRICS_DAY,
    METRICS_RANGE,
    SESSION_RANGE,
)

CTES.update({
    # cleaned datasets
    "tc": "SELECT * FROM t WHERE user_id IS NOT NULL AND n_items > 0",
    "tic": "SELECT ti.* FROM ti JOIN tc USING (transaction_id)",
    "pc": """SELECT * FROM p WHERE product_id IS NOT NULL AND category_id IS NOT NULL
             AND base_price IS NOT NULL AND base_price > 0""",
    "svc": "SELECT sv.* FROM sv JOIN sc USING (session_id)",
})


def half_up(n: str, d: str, places: int = 2) -> str:
    """round(n / d, places) half away from zero with integer division."""
    s = 10 ** places
    return (f"(CASE WHEN ({d}) <> 0 THEN sign({n}) * ((2 * abs(CAST({n} AS HUGEINT)) * {s} + ({d})) "
            f"// (2 * CAST({d} AS HUGEINT))) / {float(s)} END)")


def money_sum(c: str) -> str:
    return f"sum(CAST({c} AS DECIMAL(18,2)))"


TS_TEXT = "'%Y-%m-%dT%H:%M:%S.%f'"

_SEG = """CASE WHEN {c} >= 5 THEN 'High Value' WHEN {c} >= 2 THEN 'Medium Value'
               ELSE 'Low Value' END"""

_TM = f"""SELECT user_id, count(transaction_id) AS total_transactions,
                 CAST({money_sum('total')} AS DOUBLE) AS total_spent,
                 {half_up(f"CAST({money_sum('total')} * 100 AS BIGINT)", "count(total) * 100")} AS avg_order_value
          FROM t GROUP BY user_id"""

_SM = f"""SELECT user_id, count(session_id) AS total_sessions,
                 CAST(sum(CASE WHEN conversion_status = 'converted' THEN 1 ELSE 0 END) AS BIGINT) AS converted_sessions,
                 CAST(sum(duration_seconds) AS DOUBLE) / count(duration_seconds) AS avg_session_duration_sec,
                 CAST(sum(n_viewed) AS BIGINT) AS total_products_viewed,
                 {half_up("sum(CASE WHEN conversion_status = 'converted' THEN 1 ELSE 0 END) * 100", "count(session_id)")}
                     AS conversion_rate
          FROM s GROUP BY user_id"""

_C360 = """SELECT u.user_id, u.state, u.city, u.country, tm.total_transactions, tm.total_spent,
                  tm.avg_order_value, sm.total_sessions, sm.converted_sessions,
                  sm.avg_session_duration_sec, sm.total_products_viewed, sm.conversion_rate
           FROM u LEFT JOIN tm ON u.user_id = tm.user_id LEFT JOIN sm ON u.user_id = sm.user_id"""

_CLVD = """SELECT c360.*,
                  round(COALESCE(total_sessions, 0) * 0.3 + COALESCE(converted_sessions, 0) * 0.5
                        + COALESCE(total_products_viewed, 0) * 0.002, 2) AS eng
           FROM c360"""
_CLVF = """SELECT clvd.*, round(CAST(COALESCE(avg_order_value, 0) AS DECIMAL(38,2)) * eng * 0.5, 2) AS fut
           FROM clvd"""
_CLV = """SELECT user_id, state, city, country, total_transactions, total_spent, avg_order_value,
                 total_sessions, converted_sessions, avg_session_duration_sec, total_products_viewed,
                 conversion_rate,
                 CAST(eng AS DOUBLE) AS engagement_score,
                 CAST(fut AS DOUBLE) AS predicted_future_value,
                 CAST(round(CAST(COALESCE(total_spent, 0) AS DECIMAL(38,2)) + fut, 2) AS DOUBLE) AS total_clv,
                 CASE WHEN round(CAST(COALESCE(total_spent, 0) AS DECIMAL(38,2)) + fut, 2) > 1000 AND eng > 10 THEN 'VIP'
                      WHEN round(CAST(COALESCE(total_spent, 0) AS DECIMAL(38,2)) + fut, 2) > 500 AND eng > 5 THEN 'High Value'
                      WHEN round(CAST(COALESCE(total_spent, 0) AS DECIMAL(38,2)) + fut, 2) > 200 THEN 'Medium Value'
                      ELSE 'Low Value' END AS customer_segment
          FROM clvf"""
_CLV_CTES = {"tm": _TM, "sm": _SM, "c360": _C360, "clvd": _CLVD, "clvf": _CLVF, "clv": _CLV}

_CS = f"SELECT user_id, CAST({money_sum('total')} AS DOUBLE) AS total_spent FROM t GROUP BY user_id"
_UBP = "SELECT product_id, CAST(COALESCE(sum(COALESCE(quantity, 0)), 0) AS BIGINT) AS units_sold FROM ti GROUP BY product_id"
_FUNNEL = """SELECT 'Viewed Product' AS stage, count(DISTINCT user_id) FILTER (WHERE n_viewed > 0) AS users FROM s
             UNION ALL
             SELECT 'Added to Cart', count(DISTINCT user_id) FILTER (WHERE has_cart) FROM s
             UNION ALL
             SELECT 'Purchased', count(DISTINCT user_id) + max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) FROM t"""
_DAILY = f"""SELECT CAST(ts AS DATE) AS date, CAST({money_sum('total')} AS DOUBLE) AS daily_sales
             FROM t GROUP BY 1"""

def row_key_sql(a: str = "") -> str:
    # epoch millis truncated (DuckDB's epoch_ms rounds)
    return (f"CAST({a}user_id AS VARCHAR) || '_' || "
            f"lpad(CAST(9999999999999 - epoch_us({a}start_time) // 1000 AS VARCHAR), 13, '0')")


_RK = row_key_sql()

_FLAT = f"""SELECT {row_key_sql('s.')} AS row_key, s.user_id,
                   s.session_id AS session_info_session_id,
                   strftime(s.start_time, {TS_TEXT}) AS session_info_start_time,
                   strftime(s.end_time, {TS_TEXT}) AS session_info_end_time,
                   CAST(s.duration_seconds AS VARCHAR) AS session_info_duration,
                   CAST(NULL AS VARCHAR) AS session_info_referrer,
                   s.device_type AS device_info_type,
                   CAST(NULL AS VARCHAR) AS device_info_os,
                   CAST(NULL AS VARCHAR) AS device_info_browser,
                   u.city AS device_info_city, u.state AS device_info_state,
                   u.country AS device_info_country,
                   CAST(NULL AS VARCHAR) AS device_info_ip,
                   s.conversion_status AS behavior_conversion_status,
                   COALESCE(vj.j, '[]') AS behavior_viewed_products,
                   CAST(s.n_viewed AS VARCHAR) AS behavior_products_viewed_count,
                   pj.j AS behavior_page_views,
                   COALESCE(cj.j, '{{}}') AS behavior_cart_contents
            FROM s LEFT JOIN u ON s.user_id = u.user_id
            LEFT JOIN vj ON vj.session_id = s.session_id
            LEFT JOIN pj ON pj.session_id = s.session_id
            LEFT JOIN cj ON cj.session_id = s.session_id"""
_FLAT_CTES = {
    "vj": """SELECT session_id, CAST(to_json(list(product_id ORDER BY product_id)) AS VARCHAR) AS j
             FROM sv GROUP BY session_id""",
    "pj": f"""SELECT session_id, CAST(to_json(list({{'timestamp': strftime(ts, {TS_TEXT}),
                     'page_type': event_type, 'product_id': pid, 'category_id': CAST(NULL AS VARCHAR),
                     'view_duration': view_duration}} ORDER BY ts, event_id)) AS VARCHAR) AS j
              FROM pv GROUP BY session_id""",
    "cj": """SELECT c.session_id, CAST(to_json(map_from_entries(list({'k': c.product_id,
                    'v': {'quantity': c.quantity, 'price': p.base_price}} ORDER BY c.product_id))) AS VARCHAR) AS j
             FROM cart c LEFT JOIN p ON p.product_id = c.product_id GROUP BY c.session_id""",
    "flat": _FLAT,
}

_VIEWS = """SELECT pid AS product_id, CAST(ts AS DATE) AS date, count(*) AS view_count,
                   count(DISTINCT user_id) AS unique_users,
                   CAST(sum(view_duration) AS DOUBLE) / count(view_duration) AS avg_view_duration,
                   count(DISTINCT session_id) AS sessions_with_view
            FROM pv WHERE pid IS NOT NULL GROUP BY 1, 2"""
_SALES = f"""SELECT product_id, CAST(ts AS DATE) AS date, CAST(sum(quantity) AS BIGINT) AS units_sold,
                    {money_sum('subtotal')} AS revenue_dec,
                    count(DISTINCT transaction_id) AS num_transactions
             FROM ti GROUP BY 1, 2"""
_METRICS = """SELECT CAST(COALESCE(v.product_id, x.product_id) AS VARCHAR) || '_' ||
                     strftime(COALESCE(v.date, x.date), '%Y%m%d') AS row_key,
                     COALESCE(v.product_id, x.product_id) AS product_id,
                     COALESCE(v.date, x.date) AS date,
                     COALESCE(v.view_count, 0) AS view_count,
                     COALESCE(v.unique_users, 0) AS unique_users,
                     v.avg_view_duration,
                     COALESCE(v.sessions_with_view, 0) AS sessions_with_view,
                     COALESCE(x.units_sold, 0) AS units_sold,
                     CAST(COALESCE(x.revenue_dec, 0) AS DOUBLE) AS revenue,
                     COALESCE(x.num_transactions, 0) AS num_transactions,
                     CAST(x.revenue_dec AS DOUBLE) / x.num_transactions AS avg_order_value,
                     CAST(x.num_transactions AS DOUBLE) / v.view_count AS conversion_rate
              FROM dv v FULL OUTER JOIN ds x ON v.product_id = x.product_id AND v.date = x.date"""
_METRICS_CTES = {"dv": _VIEWS, "ds": _SALES, "m": _METRICS}

_BEHAVIOR = ("behavior_conversion_status, behavior_viewed_products, behavior_products_viewed_count, "
             "behavior_page_views, behavior_cart_contents")

# Ordered page views as (session, index, from/to) for durations and transitions
_PVI = """SELECT session_id, ts, event_type, pid, event_id,
                 row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS view_index,
                 lead(ts) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS next_ts,
                 lead(event_type) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS next_type
          FROM pv"""


_STOCK_END = """CAST(p_size + COALESCE(sum(m.units_sold) OVER (PARTITION BY m.product_id ORDER BY m.date DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)"""


ORACLE: dict[str, str] = {
    "clean_transactions": with_ctes(
        """SELECT transaction_id, user_id, ts AS "timestamp", CAST(ts AS DATE) AS transaction_date,
                  total, status, payment_method, CAST(n_items AS INTEGER) AS n_items FROM tc""", "tc"),
    "clean_sessions": with_ctes(
        """SELECT session_id, user_id, start_time, end_time, duration_seconds, conversion_status,
                  device_type, CAST(n_viewed AS INTEGER) AS n_viewed FROM sc""", "sc"),
    "clean_products": with_ctes("SELECT product_id, name, category_id, base_price FROM pc", "pc"),
    "cleaning_report": with_ctes(
        """SELECT 'transactions' AS dataset, count(*) AS "before",
                  count(*) FILTER (WHERE user_id IS NOT NULL AND n_items > 0) AS "after",
                  count(*) - count(*) FILTER (WHERE user_id IS NOT NULL AND n_items > 0) AS removed FROM t
           UNION ALL
           SELECT 'sessions', count(*), count(*) FILTER (WHERE user_id IS NOT NULL AND n_viewed > 0),
                  count(*) - count(*) FILTER (WHERE user_id IS NOT NULL AND n_viewed > 0) FROM s
           UNION ALL
           SELECT 'products', count(*),
                  count(*) FILTER (WHERE product_id IS NOT NULL AND category_id IS NOT NULL
                                   AND base_price IS NOT NULL AND base_price > 0),
                  count(*) - count(*) FILTER (WHERE product_id IS NOT NULL AND category_id IS NOT NULL
                                   AND base_price IS NOT NULL AND base_price > 0) FROM p""",
        "t", "s", "p"),
    "bought_together": with_ctes(
        """SELECT x.product_a, pa.name AS product_a_name, x.product_b, pb.name AS product_b_name,
                  x.bought_together_count
           FROM pairs x JOIN pc pa ON pa.product_id = x.product_a JOIN pc pb ON pb.product_id = x.product_b""",
        "pc", extra={"pairs": """SELECT a.product_id AS product_a, b.product_id AS product_b,
                                        count(*) AS bought_together_count
                                 FROM tic a JOIN tic b ON a.transaction_id = b.transaction_id
                                      AND a.product_id < b.product_id GROUP BY 1, 2"""}),
    "viewed_together": with_ctes(
        """SELECT x.product_a, pa.name AS product_a_name, x.product_b, pb.name AS product_b_name,
                  x.viewed_together_count
           FROM pairs x JOIN pc pa ON pa.product_id = x.product_a JOIN pc pb ON pb.product_id = x.product_b""",
        "pc", extra={"pairs": """SELECT a.product_id AS product_a, b.product_id AS product_b,
                                        count(*) AS viewed_together_count
                                 FROM svc a JOIN svc b ON a.session_id = b.session_id
                                      AND a.product_id < b.product_id GROUP BY 1, 2"""}),
    "product_performance": with_ctes(
        """SELECT p.product_id, p.name AS product_name, p.base_price, c.name AS category_name,
                  COALESCE(ps.num_transactions, 0) AS transactions,
                  COALESCE(ps.total_quantity_sold, 0) AS quantity_sold,
                  COALESCE(ps.total_revenue, 0.0) AS revenue,
                  COALESCE(pvw.total_views, 0) AS total_views,
                  CASE WHEN pvw.total_views > 0
                       THEN (CAST(ps.num_transactions AS DOUBLE) / pvw.total_views) * 100
                       ELSE 0.0 END AS conversion_rate
           FROM pc p LEFT JOIN ps ON p.product_id = ps.product_id
                LEFT JOIN pvw ON p.product_id = pvw.product_id
                LEFT JOIN cat c ON p.category_id = c.category_id
           WHERE ps.total_revenue IS NOT NULL OR pvw.total_views IS NOT NULL
           ORDER BY revenue DESC, p.product_id LIMIT 20""",
        "pc", "cat", extra={
            "ps": f"""SELECT product_id, count(DISTINCT transaction_id) AS num_transactions,
                             CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
                             CAST({money_sum('subtotal')} AS DOUBLE) AS total_revenue
                      FROM tic GROUP BY product_id""",
            "pvw": "SELECT product_id, count(*) AS total_views FROM svc GROUP BY product_id"}),
    "user_behavior": with_ctes(
        f"""SELECT u.user_id, u.state, count(DISTINCT t.transaction_id) AS total_purchases,
                   CAST({money_sum('t.total')} AS DOUBLE) AS total_spent,
                   CAST({money_sum('t.total')} AS DOUBLE) / count(t.total) AS avg_order_value,
                   count(DISTINCT s.session_id) AS total_sessions,
                   {_SEG.format(c='count(DISTINCT t.transaction_id)')} AS customer_segment
            FROM u LEFT JOIN tc t ON u.user_id = t.user_id LEFT JOIN sc s ON u.user_id = s.user_id
            GROUP BY u.user_id, u.state
            HAVING count(DISTINCT t.transaction_id) > 0
            ORDER BY total_spent DESC, u.user_id LIMIT 20""", "u", "tc", "sc"),
    "user_behavior_exact": with_ctes(
        f"""SELECT u.user_id, u.state, ta.total_purchases, CAST(ta.spent AS DOUBLE) AS total_spent,
                   CAST(ta.spent AS DOUBLE) / ta.n_totals AS avg_order_value,
                   COALESCE(sa.total_sessions, 0) AS total_sessions,
                   {_SEG.format(c='ta.total_purchases')} AS customer_segment
            FROM u JOIN ta ON u.user_id = ta.user_id LEFT JOIN sa ON u.user_id = sa.user_id
            WHERE ta.total_purchases > 0
            ORDER BY total_spent DESC, u.user_id LIMIT 20""", "u",
        extra={"ta": f"""SELECT user_id, count(DISTINCT transaction_id) AS total_purchases,
                                {money_sum('total')} AS spent, count(total) AS n_totals
                         FROM tc GROUP BY user_id""",
               "sa": "SELECT user_id, count(DISTINCT session_id) AS total_sessions FROM sc GROUP BY user_id"}),
    "session_funnel": with_ctes(
        """SELECT conversion_status, count(*) AS session_count, count(DISTINCT user_id) AS unique_users,
                  CAST(sum(duration_seconds) AS DOUBLE) / count(duration_seconds) / 60.0 AS avg_duration_minutes,
                  CAST(sum(n_viewed) AS DOUBLE) / count(n_viewed) AS avg_products_viewed,
                  device_type
           FROM sc GROUP BY conversion_status, device_type""", "sc"),
    "top_selling_products": with_ctes(
        """SELECT product_id, CAST(COALESCE(sum(quantity), 0) AS BIGINT) AS total_quantity_sold FROM ti
           GROUP BY product_id ORDER BY total_quantity_sold DESC, product_id LIMIT 10""", "ti"),
    "most_viewed_products": with_ctes(
        """SELECT pid AS product_id, count(*) AS views FROM pv WHERE pid IS NOT NULL
           GROUP BY pid ORDER BY views DESC, product_id LIMIT 10""", "pv"),
    "revenue_by_category": with_ctes(
        f"""SELECT p.category_id, CAST({money_sum('ti.subtotal')} AS DOUBLE) AS total_revenue
            FROM ti JOIN p ON ti.product_id = p.product_id
            GROUP BY p.category_id ORDER BY total_revenue DESC, p.category_id LIMIT 10""", "ti", "p"),
    "user_segmentation": with_ctes(
        f"""SELECT user_id, count(*) AS transactions_count,
                   CAST(COALESCE({money_sum('total')}, 0) AS DOUBLE) AS total_spent
            FROM t GROUP BY user_id
            ORDER BY transactions_count DESC, user_id LIMIT 10""", "t"),
    "session_metrics": with_ctes("SELECT * FROM sm", "s", extra={"sm": _SM}),
    "transaction_metrics": with_ctes("SELECT * FROM tm", "t", extra={"tm": _TM}),
    "customer_360": with_ctes("SELECT * FROM c360", "u", "t", "s",
                              extra={k: _CLV_CTES[k] for k in ("tm", "sm", "c360")}),
    "clv": with_ctes("SELECT * FROM clv", "u", "t", "s", extra=_CLV_CTES),
    "top_customers_by_clv": with_ctes(
        "SELECT * FROM clv ORDER BY total_clv DESC, user_id LIMIT 20", "u", "t", "s", extra=_CLV_CTES),
    "segment_summary": with_ctes(
        f"""SELECT customer_segment, count(user_id) AS customers,
                   {half_up("CAST(sum(CAST(total_clv AS DECIMAL(38,2)) * 100) AS BIGINT)", "count(total_clv) * 100")}
                       AS avg_clv,
                   CAST(sum(CAST(total_spent AS DECIMAL(38,2))) AS DOUBLE) AS historical_revenue,
                   CAST(sum(CAST(predicted_future_value AS DECIMAL(38,2))) AS DOUBLE) AS predicted_revenue
            FROM clv GROUP BY customer_segment""", "u", "t", "s", extra=_CLV_CTES),
    "sales_over_time": with_ctes("SELECT * FROM daily", "t", extra={"daily": _DAILY}),
    "sales_summary": with_ctes(
        """SELECT CAST(sum(CAST(daily_sales AS DECIMAL(38,2))) AS DOUBLE) AS total_sales,
                  CAST(sum(CAST(daily_sales AS DECIMAL(38,2))) AS DOUBLE) / count(daily_sales) AS avg_daily_sales,
                  count(*) AS days
           FROM daily""", "t", extra={"daily": _DAILY}),
    "customer_spending": with_ctes("SELECT * FROM cs", "t", extra={"cs": _CS}),
    "spending_summary": with_ctes(
        """SELECT (SELECT user_id FROM cs WHERE total_spent IS NOT NULL
                   ORDER BY total_spent DESC, user_id LIMIT 1) AS top_user_id,
                  (SELECT max(total_spent) FROM cs) AS top_spent,
                  (SELECT CAST((sum(CAST(total_spent AS DECIMAL(38,2))) FILTER (WHERE rk = (n - 1) // 2)
                               + sum(CAST(total_spent AS DECIMAL(38,2))) FILTER (WHERE rk = n // 2)) / 2 AS DOUBLE)
                   FROM r) AS median_spent,
                  (SELECT count(total_spent) FROM cs) AS customers""",
        "t", extra={"cs": _CS,
                    "r": """SELECT total_spent, row_number() OVER (ORDER BY total_spent) - 1 AS rk,
                                   count(*) OVER () AS n FROM cs WHERE total_spent IS NOT NULL"""}),
    "spending_histogram": with_ctes(
        """SELECT g.bin, (SELECT mn FROM adj) + (g.bin - 1) * (((SELECT mx FROM adj) - (SELECT mn FROM adj)) / 50)
                      AS bin_start,
                  (SELECT mn FROM adj) + g.bin * (((SELECT mx FROM adj) - (SELECT mn FROM adj)) / 50) AS bin_end,
                  COALESCE(c.customers, 0) AS customers
           FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 51)) g
           LEFT JOIN (SELECT bin, count(*) AS customers FROM b GROUP BY bin) c ON c.bin = g.bin""",
        "t", extra={"cs": _CS,
                    "st": "SELECT min(total_spent) AS mn, max(total_spent) AS mx FROM cs",
                    "adj": """SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS mn,
                                     CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS mx FROM st""",
                    "b": """SELECT LEAST(CAST(floor((total_spent - (SELECT mn FROM adj)) * 50.0
                                       / ((SELECT mx FROM adj) - (SELECT mn FROM adj))) AS INTEGER) + 1, 50)
                                   AS bin
                            FROM cs WHERE total_spent IS NOT NULL"""}),
    "units_by_product": with_ctes("SELECT * FROM ubp", "ti", extra={"ubp": _UBP}),
    "top_products_15": with_ctes("SELECT * FROM ubp ORDER BY units_sold DESC, product_id LIMIT 15",
                                "ti", extra={"ubp": _UBP}),
    "best_product": with_ctes("SELECT * FROM ubp ORDER BY units_sold DESC, product_id LIMIT 1",
                              "ti", extra={"ubp": _UBP}),
    "conversion_funnel": with_ctes("SELECT * FROM f", "s", "t", extra={"f": _FUNNEL}),
    "funnel_conversion_rate": with_ctes(
        """SELECT max(users) FILTER (WHERE stage = 'Viewed Product') AS viewed,
                  max(users) FILTER (WHERE stage = 'Purchased') AS purchased,
                  CAST(max(users) FILTER (WHERE stage = 'Purchased') AS DOUBLE)
                      / max(users) FILTER (WHERE stage = 'Viewed Product') * 100 AS conversion_rate
           FROM f""", "s", "t", extra={"f": _FUNNEL}),
    "session_row_keys": with_ctes(f"SELECT {_RK} AS row_key, user_id, session_id, start_time FROM s", "s"),
    "user_sessions_flat": with_ctes("SELECT * FROM flat", "s", "u", "sv", "pv", "cart", "p",
                                    extra=_FLAT_CTES),
    "user_sessions_upsert": with_ctes(
        """SELECT CAST(user_id AS VARCHAR) || '_' || lpad(CAST(9999999999999 - epoch_ms(CAST(sdate AS TIMESTAMP)) AS VARCHAR), 13, '0')
                      AS row_key,
                  user_id, max(event_id) AS put_seq, arg_max(ts, event_id) AS last_event_time,
                  arg_max(event_type, event_id) AS last_event_type,
                  (array_agg(k ORDER BY event_id DESC))[1] AS last_product_id
           FROM ev GROUP BY user_id, sdate""", "ev"),
    "last_sessions": with_ctes(
        """SELECT user_id, row_key, session_info_session_id, session_info_start_time, device_info_type,
                  behavior_conversion_status, recency_rank
           FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY row_key) AS INTEGER) AS recency_rank FROM flat)
           WHERE recency_rank <= 5""", "s", "u", "sv", "pv", "cart", "p", extra=_FLAT_CTES),
    "all_sessions_for_user": with_ctes(
        "SELECT user_id, row_key, session_info_session_id, session_info_start_time FROM flat",
        "s", "u", "sv", "pv", "cart", "p", extra=_FLAT_CTES),
    "user_sessions_between": with_ctes(
        f"""SELECT {_RK} AS row_key, user_id, session_id, start_time FROM s
            WHERE start_time >= TIMESTAMP '{SESSION_RANGE[0]}' AND start_time < TIMESTAMP '{SESSION_RANGE[1]}'""",
        "s"),
    "last_sessions_one_user": with_ctes(
        f"SELECT * FROM flat WHERE user_id = {LOOKUP_USER} ORDER BY row_key LIMIT 5",
        "s", "u", "sv", "pv", "cart", "p", extra=_FLAT_CTES),
    "all_sessions_one_user": with_ctes(
        f"""SELECT user_id, row_key, session_info_session_id, session_info_start_time FROM flat
            WHERE user_id = {LOOKUP_USER}""", "s", "u", "sv", "pv", "cart", "p", extra=_FLAT_CTES),
    "session_by_key": with_ctes(
        f"SELECT * FROM flat WHERE row_key = '{LOOKUP_KEY}'",
        "s", "u", "sv", "pv", "cart", "p", extra=_FLAT_CTES),
    "converted_sessions_one_user": with_ctes(
        f"""SELECT user_id, row_key, session_info_session_id, session_info_start_time, behavior_conversion_status
            FROM flat WHERE behavior_conversion_status = 'converted' AND user_id = {LOOKUP_USER}""",
        "s", "u", "sv", "pv", "cart", "p", extra=_FLAT_CTES),
    "user_session_behavior": with_ctes(
        f"""SELECT user_id, row_key, {_BEHAVIOR}, recency_rank
            FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY row_key) AS INTEGER) AS recency_rank FROM flat)
            WHERE recency_rank <= 10""", "s", "u", "sv", "pv", "cart", "p", extra=_FLAT_CTES),
    "converted_sessions_for_user": with_ctes(
        """SELECT user_id, row_key, session_info_session_id, session_info_start_time, behavior_conversion_status
           FROM flat WHERE behavior_conversion_status = 'converted'""",
        "s", "u", "sv", "pv", "cart", "p", extra=_FLAT_CTES),
    "product_daily_metrics": with_ctes("SELECT * FROM m", "pv", "ti", extra=_METRICS_CTES),
    "product_metrics_range": with_ctes(
        f"""SELECT row_key, product_id, date, units_sold, revenue, num_transactions, avg_order_value,
                   conversion_rate
            FROM m WHERE date >= DATE '{METRICS_RANGE[0]}' AND date <= DATE '{METRICS_RANGE[1]}'""",
        "pv", "ti", extra=_METRICS_CTES),
    "product_metrics_one_product": with_ctes(
        f"""SELECT * FROM m WHERE product_id = {LOOKUP_PRODUCT}
            AND date >= DATE '{METRICS_RANGE[0]}' AND date <= DATE '{METRICS_RANGE[1]}'""",
        "pv", "ti", extra=_METRICS_CTES),
    "product_metrics_one_day": with_ctes(
        f"SELECT * FROM m WHERE date = DATE '{METRICS_DAY}'", "pv", "ti", extra=_METRICS_CTES),
    "product_metrics_all_families": with_ctes(
        f"""SELECT m.*, {_STOCK_END} AS stock_end, stock_end + m.units_sold AS stock_start
            FROM m LEFT JOIN part ON p_partkey = m.product_id""", "pv", "ti", extra=_METRICS_CTES),
    "product_inventory_one_day": with_ctes(
        f"""SELECT row_key, product_id, date, stock_end, stock_start FROM (
              SELECT m.row_key, m.product_id, m.date, {_STOCK_END} AS stock_end, stock_end + m.units_sold AS stock_start
              FROM m LEFT JOIN part ON p_partkey = m.product_id)
            WHERE date = DATE '{METRICS_DAY}'""", "pv", "ti", extra=_METRICS_CTES),
    "product_unique_users_in_range": with_ctes(
        f"""SELECT pid AS product_id, count(DISTINCT user_id) AS unique_users, count(DISTINCT CAST(ts AS DATE)) AS days
            FROM pv WHERE pid IS NOT NULL AND CAST(ts AS DATE) BETWEEN DATE '{SESSION_RANGE[0]}' AND DATE '{SESSION_RANGE[1]}'
            GROUP BY pid""", "pv"),
    "unique_users_by_day": with_ctes(
        """SELECT CAST(ts AS DATE) AS date, count(DISTINCT user_id) AS unique_users FROM pv
           WHERE pid IS NOT NULL GROUP BY 1""", "pv"),
    "product_current_price": with_ctes(
        """SELECT p.product_id, m.current_price, m.first_price_date, COALESCE(m.n, -0)::INTEGER AS price_points
           FROM p LEFT JOIN (SELECT product_id, arg_max(price, mth) AS current_price,
                                    CAST(min(mth) AS TIMESTAMP) AS first_price_date, count(*) AS n
                             FROM (SELECT product_id, date_trunc('month', ts) AS mth, min(unit_price) AS price
                                   FROM ti GROUP BY ALL) GROUP BY product_id) m USING (product_id)""", "ti", "p"),
    "product_revenue_in_range": with_ctes(
        f"""SELECT product_id, CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS days
            FROM m WHERE date >= DATE '{METRICS_RANGE[0]}' AND date <= DATE '{METRICS_RANGE[1]}'
            GROUP BY product_id""", "pv", "ti", extra=_METRICS_CTES),
    "product_daily_stock": with_ctes(
        """SELECT ds.product_id, ds.date, COALESCE(ds.units_sold, 0) AS units,
                  CAST(COALESCE(sum(COALESCE(ds.units_sold, 0)) OVER (PARTITION BY ds.product_id ORDER BY ds.date DESC
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS units_after,
                  units_after + p_size AS stock_end, units_after + p_size + units AS stock_start
           FROM ds JOIN part ON p_partkey = ds.product_id JOIN p ON p.product_id = ds.product_id""", "ti", "p", extra={"ds": _SALES}),
    "order_totals": with_ctes(
        """SELECT o.o_orderkey AS transaction_id,
                  CAST(COALESCE(x.sub, 0) AS DOUBLE) AS computed_subtotal,
                  CAST(COALESCE(x.sub, 0) - disc AS DOUBLE) AS computed_total,
                  CAST(COALESCE(x.ext, 0) AS DOUBLE) AS stored_subtotal,
                  o.o_totalprice AS stored_total,
                  COALESCE(x.sub, 0) = CAST(CAST(COALESCE(x.ext, 0) AS DOUBLE) AS DECIMAL(38,2)) AS subtotal_matches,
                  CAST(COALESCE(x.sub, 0) - disc AS DECIMAL(38,2)) = CAST(o.o_totalprice AS DECIMAL(38,2)) AS total_matches
           FROM (SELECT *, COALESCE(CASE WHEN o_orderkey % 2 = 0
                     THEN CAST(x.ext AS DECIMAL(18,2)) - CAST(o_totalprice AS DECIMAL(18,2))
                     ELSE CAST(x.off AS DECIMAL(18,2)) END, 0) AS disc
                 FROM orders LEFT JOIN x ON x.transaction_id = o_orderkey) o
           LEFT JOIN x ON x.transaction_id = o.o_orderkey""",
        "ti", extra={"x": f"""SELECT transaction_id,
                                    sum(round(CAST(quantity * unit_price AS DECIMAL(38,10)), 2)) AS sub,
                                    {money_sum('subtotal')} AS ext,
                                    {money_sum('CAST(subtotal AS DECIMAL(18,2)) * CAST(rebate AS DECIMAL(4,2))')} AS off
                             FROM ti GROUP BY transaction_id"""}),
    "session_conversion_status": with_ctes(
        """SELECT s.session_id, s.user_id, CAST(COALESCE(c.n, 0) AS INTEGER) AS cart_lines,
                  CASE WHEN paid.session_id IS NOT NULL THEN 'converted'
                       WHEN s.has_cart THEN 'abandoned' ELSE 'browsed' END AS derived_status
           FROM s LEFT JOIN (SELECT session_id, count(*) AS n FROM cart WHERE quantity > 0 GROUP BY 1) c
                ON c.session_id = s.session_id
           LEFT JOIN paid ON paid.session_id = s.session_id""",
        "s", "cart", extra={"paid": """SELECT DISTINCT CAST(o_custkey AS VARCHAR) || '_202401'
                                             || lpad(CAST(o_orderkey % 31 + 1 AS VARCHAR), 2, '0') AS session_id
                                      FROM orders WHERE o_orderkey % 5 <> 0"""}),
    "page_view_durations": with_ctes(
        """SELECT pvi.session_id, CAST(view_index AS INTEGER) AS view_index, pvi.ts AS "timestamp",
                  event_type AS page_type, pid AS product_id,
                  CAST(floor((epoch_us(COALESCE(next_ts, s.end_time)) - epoch_us(pvi.ts)) / 1000000) AS INTEGER)
                      AS duration_seconds
           FROM pvi JOIN s ON s.session_id = pvi.session_id""", "pv", "s", extra={"pvi": _PVI}),
    "page_transitions": with_ctes(
        """SELECT event_type AS from_page, next_type AS to_page, count(*) AS transitions,
                  CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY event_type) AS share
           FROM pvi WHERE next_type IS NOT NULL GROUP BY event_type, next_type""", "pv", extra={"pvi": _PVI}),
}

ORACLE["sessions_by_gap"] = with_ctes(
    """SELECT user_id, min(ts) AS session_start, max(ts) AS session_end,
              CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS BIGINT) AS duration_seconds,
              count(*) AS views, count(DISTINCT pid) AS products, CAST(min(ts) AS DATE) <> CAST(max(ts) AS DATE) AS crosses_midnight
       FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS nth
             FROM (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))
                                       <= 28800000000 THEN 0 ELSE 1 END AS opens FROM pv))
       GROUP BY user_id, nth""", "pv")
# the same rows by another way
ORACLE["user_sessions_between_clustered"] = ORACLE["user_sessions_between"]
ORACLE["sql_last_sessions"] = ORACLE["last_sessions_one_user"]
ORACLE["sql_product_revenue"] = ORACLE["product_revenue_in_range"]
ORACLE["user_sessions_by_batches"] = ORACLE["user_sessions_upsert"]
ORACLE["clean_sessions_from_json"] = ORACLE["clean_sessions"]
ORACLE["sessions_by_keys"] = with_ctes(
    "SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY row_key) = 1",
    "s", "u", "sv", "pv", "cart", "p", extra=_FLAT_CTES)
ORACLE["load_report"] = with_ctes(
    """SELECT 'transactions' AS dataset, count(*) AS read, count(*) FILTER (WHERE transaction_id % 10 = 3) AS rejected,
              count(*) FILTER (WHERE transaction_id % 10 <> 3 AND NOT (user_id IS NOT NULL AND n_items > 0)) AS removed,
              count(*) FILTER (WHERE transaction_id % 10 <> 3 AND user_id IS NOT NULL AND n_items > 0) AS kept FROM t
       UNION ALL
       SELECT 'sessions', count(*), count(*) FILTER (WHERE user_id % 10 = 3),
              count(*) FILTER (WHERE user_id % 10 <> 3 AND n_viewed = 0), count(*) FILTER (WHERE user_id % 10 <> 3 AND n_viewed > 0) FROM s
       UNION ALL
       SELECT 'products', count(*), count(*) FILTER (WHERE product_id % 10 = 3),
              count(*) FILTER (WHERE product_id % 10 <> 3 AND NOT base_price > 0),
              count(*) FILTER (WHERE product_id % 10 <> 3 AND base_price > 0) FROM p""", "t", "s", "p")
ORACLE["last_sessions_streamed"] = (
    "SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY row_key) AS INTEGER) AS recency_rank FROM ("
    + ORACLE["user_sessions_upsert"] + ") QUALIFY recency_rank <= 5")
