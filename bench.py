"""Time the headline queries: one warm-up, then the median of BENCH_RUNS full runs.

Every run builds its result and forces all of it with a ``noop`` write. Prints one
JSON line; ``value`` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallymart.plans import catalog
from tallymart.session import get_session

HEADLINE = [
    "silver_user_sessions", "silver_session_actions", "silver_order_items", "fact_order",
    "fact_order_items", "feat_user_behavior_3d", "bi_kpi", "bi_monthly_mom", "bi_daily_ma7",
    "bi_top_products", "bi_category_share", "bi_province_heatmap", "bi_payment_monthly",
    "campaign_rule_scored", "campaign_upsert", "dq_order_total_reconcile", "dq_relationships",
    "zorder_cluster", "stream_daily_activity",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            result = catalog.run(name, spark, folder)
            result.write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline query wall time, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
