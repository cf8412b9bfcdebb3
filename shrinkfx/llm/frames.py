"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import shrinkfx
from shrinkfx.llm import textkit


def annotated(df: DataFrame, added: dict[str, Column], columns: list[str]) -> DataFrame:
    """``columns`` of ``df`` (the caller's own) plus ``added``; a caller's column that
    bears an added name gives way."""
    taken = {c.lower() for c in added}
    return df.select(*[F.col(f"`{c}`") for c in columns if c.lower() not in taken],
                     *[v.alias(k) for k, v in added.items()])


def own(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns])


_shipped: set[str] = set()


def arrow_map(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow``, after handing this package to the workers of the application
    (they import the helpers that ``run`` uses)."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        root = Path(shrinkfx.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="shrinkfx-code-")) / "shrinkfx.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, Path("shrinkfx") / f.relative_to(root))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            textkit.release()

    return df.mapInArrow(task, schema)
