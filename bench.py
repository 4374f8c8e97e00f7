"""Time the registered queries: one warm-up pass, then the median of the timed runs; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from posttrend.catalog import QUERIES  # noqa: E402
from posttrend.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# Model fits and streams take many jobs each; one timed run of them is enough.
HEAVY = {
    "train_lr", "coef_table", "train_gbt", "feature_importance", "train_stump", "stump_importance", "cv_summary",
    "cv_summary_trees", "table_merge", "table_delete", "stream_scoring", "stream_dedupe", "stream_late", "stream_collect",
    "stream_features_sliced",
    "stream_scoring_replay",
}


def run_once(spark, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    wanted = sys.argv[1:] or list(QUERIES)
    conf = {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{CPUS}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in wanted:
        runs = [run_once(spark, name)]
        if name not in HEAVY:
            runs = [run_once(spark, name) for _ in range(RUNS)]
        times[name] = round(statistics.median(runs), 4)
    spark.stop()
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 4)
    print(json.dumps({"metric": "sum of median query seconds", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
