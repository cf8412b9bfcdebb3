"""shrinkfx: ratings analytics and regularised additive effect models on Spark.

Layout
------
sources/    readers for ``::``-delimited ratings/movies files, the test-data
            ratings view, and the shared stage-table store.
functions/  column expressions (rating week / month, movie year, labels).
operators/  DataFrame operators: keyed joins, group statistics, top-n with
            ties, the stratified split, effect fitting, sweeps and RMSE.
plans/      the assembled experiment (prepare -> sweep -> select -> refit)
            and the exploration report queries.
streaming/  incremental ingestion of ratings files (same parser, file stream).
"""

from shrinkfx.session import get_spark, shared_dir, materialize

__all__ = ["get_spark", "shared_dir", "materialize"]
