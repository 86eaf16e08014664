"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores,
BENCH_QUERIES a comma-separated choice ("all" for every query).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fareloom.plans.queries import registered  # noqa: E402
from fareloom.session import build_session  # noqa: E402

HEADLINE = (
    "driver_earnings_ranking",
    "driver_earnings_daily",
    "platform_earnings",
    "platform_earnings_daily",
    "daily_earnings_summary",
    "drivers_earnings_page",
    "drivers_earnings_summary",
    "fee_statistics",
    "revenue_share_lookup",
    "financial_split",
    "influencer_commission",
    "completion_edges",
    "affiliate_commission",
    "driver_referral_commission",
    "commission_decision_log",
    "influencer_total_earnings",
    "outbox_build",
    "projection_latest",
    "outbox_pending",
    "latest_event",
    "chat_room_rollup",
    "payment_validate",
    "payment_intents_accepted",
    "payment_confirm_outcome",
    "payment_latest_status",
    "document_compliance",
    "constraint_violations",
    "sync_latency",
    "stream_daily_earnings",
    "stream_completion_edges",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries = registered()
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = build_session(
        "fareloom-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")},
    )
    spark.sparkContext.setLogLevel("OFF")
    # load classes and start the code cache before the clock runs
    queries["orders_by_status"](spark, directory).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, directory).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(directory.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
