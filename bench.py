"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is forced with a no-op write (full computation, nothing collected), under the
default broadcast limit. Every entry is computed cold, over the prepared splits, but for
``final_validation_rmse``, which reads the leaderboard that the entry before it has written.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shrinkfx import get_spark  # noqa: E402
from shrinkfx.plans import catalog  # noqa: E402
from shrinkfx.session import drop_stages  # noqa: E402
from shrinkfx.plans import experiment as X  # noqa: E402

HEADLINE = [
    "leaderboard",            # 1,090 models: 10 families x 121 alphas
    "final_validation_rmse",  # refit best chain on edx, score validation
    "model_mugyw",            # five-effect chain at one alpha
    "sweep_chain",            # all chain prefixes x 121 alphas, fitted and scored
    "sweep_single_effects",
    "activity_all_features",
    "boxplot_activity",
    "best_worst_movies",
    "user_activity_percentiles",
    "avg_by_month",
    "hist_user_avg",
    "kde_user_avg",
    "dataset_profile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app="shrinkfx-bench", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": "16g",
                             "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="shrinkfx-bench-")})
    times: dict[str, float] = {}
    t0 = time.time()
    X.prepare(spark, sf_dir)
    times["prepare_splits"] = round(time.time() - t0, 3)
    qs = catalog.queries()
    for name in HEADLINE:
        t = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_time", "value": total, "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    drop_stages(spark)
    spark.stop()


if __name__ == "__main__":
    main()
