"""Time the headline queries and print one JSON line.

Each query is built and run to the end over the whole tables; results go to a sink
that drops them. The first run of a query (``cold``) also compiles its code; it is
followed by warm runs, of which the median counts. Three of them, but when the bench has
run for ``BENCH_SECONDS`` (default 600) queries are not repeated further, and the cold time counts.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from touchline.session import drop_materialised, local_session
from workload.queries import REGISTRY

HEADLINE = (
    "features_base lagged_features streaks ragged_split harmonise_players team_aggregate page_tables match_candidates "
    "match_map name_auto_map compile_map fraction_split median_impute describe_numeric corr_matrix null_profile "
    "eval_log_loss class_report reliability odds_benchmark_row blend_search fill_derived score_edges score_edges_raw"
).split()


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="touchline-bench")
    spark.sparkContext.setLogLevel("ERROR")
    run(REGISTRY["entity_names"](spark, sf_dir))
    limit = float(os.environ.get("BENCH_SECONDS", "600"))
    cold, seconds, runs, began = {}, {}, {}, time.perf_counter()

    def timed(name: str) -> float:
        start = time.perf_counter()
        run(REGISTRY[name](spark, sf_dir))
        return round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        cold[name], warm = timed(name), []
        while len(warm) < 3 and time.perf_counter() - began < limit * (len(cold) / len(HEADLINE)):
            warm.append(timed(name))
        seconds[name], runs[name] = round(median(warm or [cold[name]]), 3), len(warm)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}
    line |= {"cold": cold, "cold_total": round(sum(cold.values()), 3), "warm_runs": runs}
    print(json.dumps(line))
    drop_materialised(spark)
    spark.stop()


if __name__ == "__main__":
    main()
