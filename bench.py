"""Benchmark: wall time of the headline reports at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3: median of that many timed runs after one warm-up).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from personalens.plans.registry import all_queries  # noqa: E402
from personalens.session import get_session  # noqa: E402

HEADLINE = [
    "review_persona_attributes", "ad_persona_attributes", "ad_personas_from_review_analysis",
    "unified_persona_attributes", "review_ranking", "ad_performance", "opportunity_index",
    "cross_account_mapping", "scorecard", "gap_analysis", "gap_analysis_simple",
    "cross_system_analysis", "account_opportunities",
]


def run_once(q, spark, sf_dir) -> float:
    t0 = time.perf_counter()
    q.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "8g"})
    qs = all_queries()
    names = [n for n in HEADLINE if n in qs]
    times = {}
    for name in names:
        run_once(qs[name], spark, sf_dir)
        times[name] = round(statistics.median(
            run_once(qs[name], spark, sf_dir) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_sec_headline_reports", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
