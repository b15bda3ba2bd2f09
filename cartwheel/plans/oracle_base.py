"""DuckDB SQL for the adapter tables, written independently of the Spark code.

Each query's oracle is ``WITH <needed CTEs> SELECT ...`` over the raw test
tables (region nation customer part orders lineitem events). The CTEs here
are flat (one row per user / product / order / order line / session / page
view) — the oracle never builds nested documents.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {
    # users: one row per customer, geo names from nation/region
    "u": """SELECT c.c_custkey AS user_id, n.n_name AS state, n.n_name AS city, r.r_name AS country
            FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
            LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "p": """SELECT p_partkey AS product_id, p_name AS name, p_brand AS category_id,
                   p_retailprice AS base_price FROM part""",
    "cat": """SELECT DISTINCT p_brand AS category_id, p_brand AS name FROM part""",
    # transaction lines (lineitem rows whose order exists)
    "ti": """SELECT l.l_orderkey AS transaction_id, o.o_custkey AS user_id, o.o_orderdate AS ts,
                    l.l_partkey AS product_id, CAST(l.l_quantity AS INTEGER) AS quantity,
                    l.l_extendedprice / l.l_quantity AS unit_price, l.l_extendedprice AS subtotal,
                    l.l_linenumber AS ln, l.l_discount AS rebate
             FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    # transactions: one row per order, with its number of lines
    "t": """SELECT o.o_orderkey AS transaction_id, o.o_custkey AS user_id, o.o_orderdate AS ts,
                   o.o_totalprice AS total, o.o_orderstatus AS status,
                   o.o_orderpriority AS payment_method, COALESCE(li.n, 0) AS n_items
            FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) li
                 ON li.l_orderkey = o.o_orderkey""",
    "ev": """SELECT event_id, ts, user_id, event_type,
                    TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
                    CAST(ts AS DATE) AS sdate
             FROM events""",
    # page views: events with their session id and seconds to the next event
    "pv": """SELECT ev.*, CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
                    CASE WHEN event_type = 'view' THEN k END AS pid,
                    COALESCE(CAST(floor((epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 1000000) AS INTEGER), 0)
                        AS view_duration
             FROM ev WINDOW w AS (PARTITION BY user_id, sdate ORDER BY ts, event_id)""",
    # sessions: one row per (user, day)
    "s": """SELECT session_id, user_id, sdate, min(ts) AS start_time, max(ts) AS end_time,
                   CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS INTEGER) AS duration_seconds,
                   count(DISTINCT pid) AS n_viewed,
                   CASE WHEN bool_or(event_type = 'purchase') THEN 'converted'
                        WHEN bool_or(event_type = 'click') THEN 'abandoned'
                        ELSE 'browsed' END AS conversion_status,
                   CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
                   bool_or(event_type = 'click' AND k IS NOT NULL) AS has_cart
            FROM pv GROUP BY session_id, user_id, sdate""",
    # distinct viewed products per session
    "sv": """SELECT DISTINCT session_id, user_id, pid AS product_id FROM pv WHERE pid IS NOT NULL""",
    # sessions kept by cleaning (at least one viewed product)
    "sc": """SELECT * FROM s WHERE n_viewed > 0""",
    "cart": """SELECT session_id, user_id, k AS product_id, CAST(count(*) AS INTEGER) AS quantity
               FROM pv WHERE event_type = 'click' AND k IS NOT NULL GROUP BY 1, 2, 3""",
}

_NAME = re.compile(r"\b([a-z_]+)\b")


def _deps(name: str) -> list[str]:
    return [d for d in dict.fromkeys(_NAME.findall(CTES[name])) if d in CTES and d != name]


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding ``names``, their dependencies, and ``extra`` CTEs
    (defined after them, in the given order), followed by ``body``."""
    extra = extra or {}
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    wanted = list(names)
    for sql in extra.values():
        wanted += [d for d in _NAME.findall(sql) if d in CTES]
    for n in wanted:
        visit(n)
    parts = [f"{n} AS ({CTES[n]})" for n in order]
    parts += [f"{n} AS ({sql})" for n, sql in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
