"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the local cores.
BENCH_ONLY, a comma-separated list, restricts the run to some queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelmill.plans.catalogue import QUERIES  # noqa: E402
from parcelmill.session import build_session, drop_staged  # noqa: E402

HEADLINE = [
    "type_frequency", "missing_profile", "numeric_describe", "price_histogram", "keep_last_per_key",
    "value_rule_flags", "flag_summary", "iqr_bounds", "clean_before_after", "segment_sold",
    "monthly_market", "market_month_kpi", "mom_yoy", "market_metrics", "rate_enrich", "top_agents",
    "top_agents_per_county", "zip_layers", "gold_q2", "statement_audit", "attempt_rollup", "forecast",
    "isolation_scores", "avm_score",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_ONLY", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Load classes and compile hot code on the smallest tables first.
    warm = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in names if os.path.isdir(warm) else []:
        QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    drop_staged(spark)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
