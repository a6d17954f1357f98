"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from touchline import build_session, registry

HEADLINE = [
    "fct_club_season_performance", "int_player_season_performance", "dim_clubs", "dim_players",
    "fct_player_match_performance", "fct_player_rolling_form", "fct_transfer_market_value_analysis",
    "fct_transfer_fixed_horizon_outcomes", "fct_transfer_cohort_performance", "fct_data_coverage_bias",
    "fct_club_risk_profile", "fct_club_transfer_portfolio", "fct_agent_portfolio",
    "ml_player_market_value_training", "ml_player_market_value_scoring",
    "check_grains", "check_foreign_keys", "model_rolling_folds", "model_conformal_radius",
]
#: Run first and not counted: starts the executors and compiles the common code.
WARM_UP = "stg_competitions"


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    all_queries = registry.queries()
    all_queries[WARM_UP](spark, root).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        all_queries[name](spark, root).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
