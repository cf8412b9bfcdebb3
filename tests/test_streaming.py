import os
import tempfile

from shrinkfx.streaming import ingest_ratings


def test_incremental_ingest_is_exactly_once(spark):
    d = tempfile.mkdtemp(prefix="shrinkfx-stream-")
    src, out, ck = (os.path.join(d, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    with open(os.path.join(src, "a.dat"), "w") as f:
        f.write("1::10::4.5::100\n2::11::3::200\n")
    ingest_ratings(spark, src, out, ck)
    assert spark.read.parquet(out).count() == 2
    with open(os.path.join(src, "b.dat"), "w") as f:
        f.write("3::12::5::300\n")
    ingest_ratings(spark, src, out, ck)  # only the new file is read
    rows = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert rows == [(1, 10, 4.5, 100), (2, 11, 3.0, 200), (3, 12, 5.0, 300)]
