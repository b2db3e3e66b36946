"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the given tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_QUERIES  "headline" (default), "all", or names separated by commas
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import QUERIES
from hearthline.session import local_session

HEADLINE = (
    "monthly_closings monthly_closings_by_buyer buyer_share registrations_by_product loan_details "
    "correspondent_dashboard monthly_metrics star_dim_loan star_borrowers latest_per_key scd2 backfill_prices "
    "flatten_document grid_rows fact_procurement loan_master kpi_scorecard month_trend avg_premium_by_month "
    "quality_checks servicing_scorecard partition_publish"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    chosen = os.environ.get("BENCH_QUERIES", "headline")
    names = {"headline": HEADLINE, "all": list(QUERIES)}.get(chosen) or chosen.split(",")
    spark = local_session("bench", cpus, **{"spark.sql.shuffle.partitions": cpus})
    spark.range(1000).selectExpr("sum(id)").collect()
    # Work that never changes: its seconds tell how fast the machine is just now.
    steady = "select sum(hash(id, id * 7, cast(id as string))) from range(0, 60000000, 1, 16)"
    spark.sql(steady.replace("60000000", "6000000")).collect()
    begin = time.time()
    spark.sql(steady).collect()
    calibration = round(time.time() - begin, 3)
    seconds = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries" if chosen == "headline" else f"total wall time: {chosen}",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "calibration": calibration,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
