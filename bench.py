"""Time registered queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3), and BENCH_QUERIES: names
separated by commas, or ``all``; by default the headline queries. Each query runs once to warm up; its time is the
median of the runs after that, planning and stored intermediate tables included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "raw_sales_union",
    "dim_clients",
    "dim_products",
    "fact_sales",
    "clients_total_revenue",
    "train_pairs",
    "train_test_split",
    "train_candidates",
    "train_report",
    "evaluate_all_models",
    "backlog_pairs",
    "score_backlog",
    "score_pandas_udf",
    "monitor_metrics",
    "gate_should_retrain",
    "ledger_runs_wide",
    "ledger_best_run",
    "ledger_hard_delete_runs",
    "ledger_promote",
    "sink_rebuild_table",
    "sink_append",
]


def main() -> None:
    from tillcast import registry, session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries = registry.queries()
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = session.build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    session.clean_up(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
