"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and run to completion once to warm up, then timed (median of the
remaining runs)."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from carelattice.session import build_session
from suite.registry import QUERIES

HEADLINE = [
    "claim_running", "enrollment_spans", "hcc_risk", "pmpm", "provider_ranking", "readmissions",
    "member_months", "member_roster", "omop_condition", "omop_drug", "medication_adherence",
    "condition_drug_pairs", "condition_prevalence", "discharge_features", "current_features",
    "contract_quality", "warehouse_checks", "cohort", "patient_360", "iqr_flag", "risk_report",
    "phi_joinable", "deidentify_table", "silver_events", "silver_stream", "form_fields",
    "exact_quantiles", "isolation_forest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.driver.host": "127.0.0.1", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.time() - started)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
