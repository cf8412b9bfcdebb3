"""Run the whole experiment and print its result lines and summary table.

usage:
  python tools/run_experiment.py --sf-dir /root/testdata/sf0.01
  python tools/run_experiment.py --ratings ratings.dat --movies movies.dat [--grid 0 30 0.25]
"""

from __future__ import annotations

import argparse
import sys

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from shrinkfx import get_spark  # noqa: E402
from shrinkfx.session import drop_stages  # noqa: E402
from shrinkfx.plans import experiment as X  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir")
    ap.add_argument("--ratings")
    ap.add_argument("--movies")
    ap.add_argument("--grid", nargs=3, type=float, default=(0.0, 30.0, 0.25), metavar=("LO", "HI", "STEP"))
    ap.add_argument("--alpha-batch", type=int, default=None)
    ap.add_argument("--master", default=None)
    ap.add_argument("--stages", help="shared folder for stage tables (spark.checkpoint.dir)")
    a = ap.parse_args()
    cfg = X.Config(grid=tuple(a.grid), alpha_batch=a.alpha_batch)
    spark = get_spark(a.master, extra={"spark.checkpoint.dir": a.stages} if a.stages else None)
    if a.sf_dir:
        p = X.prepare(spark, a.sf_dir, cfg)
    elif a.ratings and a.movies:
        p = X.prepare_ratings(X.load_ratings_files(spark, a.ratings, a.movies), cfg)
    else:
        ap.error("give --sf-dir or --ratings and --movies")
    lb = X.leaderboard(p, cfg=cfg)
    b = X.best(lb).first()
    print("Best model (test set):", b.model, "alpha:", b.alpha, "test RMSE:", round(b.rmse, 7))
    f = X.final_validation(p, b.model, b.alpha, cfg).first()
    print("Final (validation):", f.model, "alpha:", f.alpha, "validation RMSE:", round(f.rmse, 7),
          f"({f.n} rows, {f.n_unseen_rows} with an unseen key)")
    X.summary(lb).select(*[F.round(c, 7).alias(c) if c.endswith("rmse") else F.col(c)
                           for c in X.summary(lb).columns]).show(truncate=False)
    drop_stages(spark)
    spark.stop()


if __name__ == "__main__":
    main()
