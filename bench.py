"""Seconds per headline query: prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local threads (default 8).
"""

from __future__ import annotations

import json
import os
import time

from framelake.plans import registry
from framelake.session import build_session

HEADLINE = ["w1_keyframes", "a1_scene_statistic", "w4_running_counters", "w2_pair_diff", "p9_coarse_scenes", "p12_topk_softmax",
            "f3_diversity_select", "sk2_upsert_frames", "d2_nms", "j4_match", "a10_average_precision", "d6_evaluate", "p18_iou", "p25_annotation_labels",
            "p13_sample", "p14_round_robin", "j2_locate", "a7_bucketed_count_week", "st4_rolling_statistic", "st6_counter_rate",
            "w5_count_window", "d9_track", "p16_frame_profile"]


def run(spark, name: str, sf: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(spark, name, sf)
        times[name] = round(min(run(spark, name, sf) for _ in range(2)), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
