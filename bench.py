"""Headline timings: one JSON line with seconds per query."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hazardloom.plans.catalog import CATALOG  # noqa: E402
from hazardloom.plans.session import session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "terminal_record", "survival_table", "population_summary", "km_overall", "km_by_stratum",
    "hazard_overall", "aalen_johansen", "stratified_incidence", "horizon_targets",
    "feature_matrix", "cox_fit", "cox_base_model", "cox_macro_model", "model_metrics",
    "stratified_metrics", "calibration", "concordance", "panel_profile", "current_ltv",
    "andersen_gill_fit", "time_varying_model", "landmark_dynamic", "fine_gray_weighted",
    "ranking_loss", "loan_cash_flows", "portfolio_scenarios", "logistic_horizons", "nonlinear_cox_model", "exact_tree",
]


def main() -> None:
    spark = session("bench", f"local[{CPUS}]", int(CPUS), spark__ui__enabled="false",
                    spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    CATALOG["term_filter"].run(spark, FOLDER).write.format("noop").mode("overwrite").save()  # warm-up
    times: dict[str, float] = {}
    for name in HEADLINE:
        t = time.time()
        CATALOG[name].run(spark, FOLDER).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
