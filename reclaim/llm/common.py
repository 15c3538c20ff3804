"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, materialize

MB = 1 << 20
# Groups beyond this share partitions, so the driver's task lists stay short.
MOST_PARTITIONS = 20_000


# Arrow batches between the JVM and Python workers: whole texts are wide rows,
# and both sides hold a batch in memory.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * MB),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Session defaults (UTC, AQE, checkpoint folder) and small Arrow batches."""
    configure(spark)
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the session is prepared."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back."""
    return materialize(df, f"llm-{name}")


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def partitions(groups: int) -> int:
    """Partitions for so many groups of bounded size."""
    return max(1, min(groups, MOST_PARTITIONS))


def total_bytes(df: DataFrame, c: str = "text") -> int:
    return int(df.agg(F.sum(F.octet_length(F.col(c)).cast("long"))).first()[0] or 0)


def shards(df: DataFrame, mb: int, c: str = "text", least: int = 1) -> int:
    """Number of shards of about ``mb`` MB of text each: follows the input."""
    return max(least, -(-total_bytes(df, c) // (mb * MB)))


def in_worker(key: tuple, make: Callable[[], object]) -> object:
    """One object for each Python worker process and key, whatever the number
    of tasks that the process runs (functions are pickled by value, so their
    own modules do not outlive a task)."""
    held = sys.modules.setdefault("_reclaim_worker", ModuleType("_reclaim_worker")).__dict__
    if key not in held:
        for old in [k for k in held if isinstance(k, tuple) and k[0] == key[0]]:
            del held[old]  # at most one of a kind
        held[key] = make()
    return held[key]


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, with memory that it freed given back to the
    system when the task ends: worker processes serve many tasks and stages,
    and would keep the largest one's memory."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def release() -> None:
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)
