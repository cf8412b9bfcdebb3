"""Print the executed physical plans (after AQE) of the key operators.

usage: python tools/show_plans.py [sf_dir] > PLANS.md
Only operator lines are kept (scans with their pushed filters / read schema,
exchanges, joins, aggregates, windows, generators).
"""

from __future__ import annotations

import re
import sys
import tempfile

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from shrinkfx import get_spark  # noqa: E402
from shrinkfx.operators import sweep as SW  # noqa: E402
from shrinkfx.operators.keys import key_registry  # noqa: E402
from shrinkfx.plans import catalog  # noqa: E402
from shrinkfx.plans import experiment as X  # noqa: E402

KEEP = re.compile(r"(Scan|Exchange|Join|Aggregate|Window|Generate|TakeOrdered|Union|Subquery|Reused|Sort |Filter)")


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def trim(plan: str) -> str:
    out = []
    for line in plan.split("\n"):
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: <stage table>", line)
            out.append(line[:220])
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="shrinkfx-plans-")})
    p = X.prepare(spark, sf)
    alphas = X.Config().alphas
    sections = []
    sections.append(("Stratified split (quartile strata, seed 1): a comparison with the stored hash", p.split1))
    sections.append(("A count over train: the split's folder alone is read", p.train.groupBy("user_id").count()))
    sections.append(("Keys that only held-out rows have, for five keys in one scan",
                     key_registry(p.split2, X.FULL_CHAIN, "is_test").groupBy("kind", "key").agg(F.every("is_test").alias("held")).where("held")))
    sweep, grid = SW.ChainSweep(p.train, p.test, X.FULL_CHAIN, p.mu), SW.Grid(alphas)
    met, effects = sweep._second(grid)
    sections.append(("Chain sweep, second effect (users): thin rows dealt by user, spread over the grid's blocks and summed in place", effects))
    sections.append(("Chain sweep, residuals after two effects: rows meet the effects where they are", sweep._residuals(met, grid)))
    sections.append(("Chain sweep: the last step over written pieces",
                     sweep.scores(alphas)))
    sections.append(("Single-effect sweep (sufficient statistics)",
                     SW.sweep_single(p.train, p.test, "user_id", alphas, p.mu)))
    q = catalog.QUERIES
    for name in ["model_mugyw", "best_movies", "kde_user_avg", "activity_all_features", "boxplot_activity", "dataset_profile"]:
        sections.append((f"Query `{name}`", q[name](spark, sf)))
    print("# Executed physical plans (after AQE), sf0.01, local[8]\n")
    print("Generated by `python tools/show_plans.py`; operator lines only.\n")
    for title, df in sections:
        print(f"## {title}\n\n```\n{trim(executed(df))}\n```\n")


if __name__ == "__main__":
    main()
