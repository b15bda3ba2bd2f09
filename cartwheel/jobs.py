"""Batch jobs that write the shop's result sets as folders, one per result.

    python -m cartwheel.jobs --json /data/generated --out /results --job all
    python -m cartwheel.jobs --testdata /root/testdata/sf0.01 --out /tmp/r --land /tmp/landed

Each job computes its results from one :class:`Shop` and writes them with the
sinks (CSV with header by default). ``--single-file`` writes one file per
result (for small chart data read by a single process); it is off by default
because a full pair table is not small.
"""

from __future__ import annotations

import argparse
import sys

from cartwheel.plans.queries import QUERIES
from cartwheel.session import build_session, configure
from cartwheel.sinks import write_csv, write_parquet
from cartwheel.sources.catalog import Shop

# Result folder names, per job, and the query each one holds.
JOBS: dict[str, dict[str, str]] = {
    "batch": {
        "product_recommendations_bought": "bought_together",
        "product_recommendations_viewed": "viewed_together",
        "product_performance_analysis": "product_performance",
        "user_behavior_analysis": "user_behavior",
        "session_funnel_analysis": "session_funnel",
    },
    "clv": {
        "clv_analysis": "clv",
        "segment_summary": "segment_summary",
    },
    "charts": {
        "sales_over_time": "sales_over_time",
        "customer_spending": "customer_spending",
        "top_products": "units_by_product",
        "conversion_funnel": "conversion_funnel",
    },
}


def run_job(shop: Shop, job: str, out_dir: str, fmt: str = "csv",
            single_file: bool = False) -> dict[str, str]:
    """Compute and write every result of ``job``; returns {folder: path}."""
    written = {}
    for folder, query in JOBS[job].items():
        path = f"{out_dir.rstrip('/')}/{folder}"
        df = QUERIES[query](shop)
        if fmt == "csv":
            write_csv(df, path, single_file=single_file)
        else:
            write_parquet(df, path)
        written[folder] = path
    return written


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m cartwheel.jobs")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--json", help="folder with users.json, products.json, ... sessions_*.json")
    src.add_argument("--testdata", help="folder with the star-schema test tables")
    src.add_argument("--landed", help="folder written by a previous --land")
    ap.add_argument("--out", required=True)
    ap.add_argument("--job", choices=[*JOBS, "all"], default="all")
    ap.add_argument("--land", help="write the datasets here first and read them back")
    ap.add_argument("--format", choices=["csv", "parquet"], default="csv")
    ap.add_argument("--single-file", action="store_true")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit on a cluster")
    a = ap.parse_args(argv)

    spark = build_session(a.master) if a.master else configure(build_session())
    if a.json:
        shop = Shop.from_json(spark, a.json)
    elif a.testdata:
        shop = Shop.from_testdata(spark, a.testdata)
    else:
        shop = Shop.from_landed(spark, a.landed)
    if a.land:
        shop = shop.land(a.land, bucketed=False)
    for job in (JOBS if a.job == "all" else [a.job]):
        for folder, path in run_job(shop, job, a.out, a.format, a.single_file).items():
            print(f"{job}: {folder} -> {path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
