"""Times the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs per query after one warm-up, the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "D1_bars_eod", "D5_bars_intraday_1min", "D6_quotes", "E10_indicator_grid", "M4_movers", "M3_sector_pe_history",
    "B2_refresh_stored", "B8_merge_insider", "B16_facts_panel", "B19_recompute_dirty", "B22_failure_streaks",
    "J4_holder_analytics", "J5_holder_performance", "J8_industry_summary", "K2_insider_stats", "L1_etf_holdings",
    "F1_income_statement_annual", "F6_scores", "F13_dcf_custom", "I4_target_consensus", "I8_grades_consensus",
    "N5_cot_report", "H5_calendar_summary", "A3_overwrite_keys", "P1_stream_bars",
]


def main() -> None:
    from marketmill import plans
    from marketmill.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = plans.load().QUERIES
    seconds = {}
    for name in HEADLINE:
        taken = []
        for run in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:
                taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
