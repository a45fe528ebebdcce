"""What several operators of this package share."""

from __future__ import annotations

import ctypes
import math
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import materialise, scratch_path

__all__ = ["materialise", "materialise_by", "scratch_path", "table", "parts_for", "ship", "give_back", "giving_back"]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of all executors, once per application: they need not have it
    installed nor start in its folder."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="cityloom-code-")) / "cityloom.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise_by(df: DataFrame, key: str, label: str) -> DataFrame:
    """Like ``materialise``, bucketed by ``key`` without a shuffle: each task writes its rows into the files
    of their buckets, and what later meets them by ``key`` is brought to them. There are as many buckets as
    shuffle partitions."""
    spark = df.sparkSession
    name = f"cityloom_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", scratch_path(spark, label)).bucketBy(buckets, key).saveAsTable(name)
    made = spark.table(name)
    made.schema  # resolved before the name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return made


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    """How many parts a table of so many rows is cut into; grows with the rows, without a limit."""
    return max(least, math.ceil(rows / per_part))


def give_back() -> None:
    """Return what a Python worker has freed to the system. Workers live on between tasks, and several of them share the
    memory of an executor: what one keeps for its next task, the others lack."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def giving_back(
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, with ``give_back`` when a task is through."""

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return through
