"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwell.session import new_scratch_dir

#: Characters of text that one step of a Python task holds at a time.
STEP_CHARS = 8_000_000

_shipped: set[str] = set()


_kept: dict[str, dict] = {}


def kept_by(operator: str) -> dict:
    """What a worker's Python keeps for an operator from task to task.  What it
    kept for others goes, as workers serve many stages and queries and would
    hold the memory of all of them."""
    for other in [x for x in _kept if x != operator]:
        del _kept[other]
        pa.default_memory_pool().release_unused()
    return _kept.setdefault(operator, {})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python (Spark's own file server)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="martwell-code-"), "martwell_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage,
    so a lost executor costs a re-read and not the work before."""
    path = new_scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def steps(batch: pa.RecordBatch, column: int, limit: int = STEP_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes in a text column at most
    (one row at least), so that long texts don't add up in a task."""
    rows = batch.num_rows
    if not rows:
        return
    sizes = batch.column(column).fill_null("")
    lengths = pa.compute.binary_length(sizes).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i in range(rows):
        if i > start and held + int(lengths[i]) > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(lengths[i])
    yield batch.slice(start)


