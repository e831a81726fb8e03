"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the data
and the cores. Every query is built and fully written to a no-op sink. The first
query of a session also pays for JVM and Python worker start, so one warm-up query
runs before the clock starts.
"""

from __future__ import annotations

import json
import os
import time

from duelboard.catalog import load_catalog
from duelboard.session import build_session

HEADLINE = (
    "a2_model_scores",
    "a2_model_scores_lineitem",
    "a3_bootstrap_leaderboard",
    "a3_bootstrap_lineitem",
    "a3_bootstrap_draws",
    "c1_verdict_label",
    "c2_comparison_reply",
    "c17_style_metadata",
    "c7_parse_transcript",
    "c8_prompt_example",
    "j5_paired_answers",
    "j7_swapped_games",
    "j8_common_instructions",
    "j9_style_joined_battles",
    "a8_bootstrap_fits",
    "a10_style_leaderboard",
    "a13_win_rates",
    "a14_best_and_worst",
    "e2_pairwise_judging",
    "e3_comparison_round",
    "e4_preference_pairs",
    "w4_running_history",
    "st3_running_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_catalog()
    warm = sf_dir.replace("sf0.1", "sf0.001") if "sf0.1" in sf_dir else sf_dir
    queries["e4_preference_pairs"](spark, warm).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
