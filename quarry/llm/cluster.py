"""Session helpers of this subpackage: shared folders, row identities, batches and memory."""

from __future__ import annotations

import ctypes
import functools
import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.shared import removed, shared_folder  # noqa: F401

#: Bytes of text that one batch of documents holds on average, at least.
BATCH_BYTES = 6 << 20
#: Bytes of keys, on average, of a batch in a bucket at least: batches grow with the square root of the data.
RUN_BYTES = 640
BATCH = "__batch"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it back: later failures restart from there."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return int(docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0)


def batch_count(total_bytes: int) -> int:
    """Batches (and buckets) of a corpus: of 6 MiB up to 60 GB, then of sqrt(total * RUN_BYTES) bytes."""
    return max(8, math.ceil(total_bytes / max(BATCH_BYTES, math.isqrt(total_bytes * RUN_BYTES))))


def in_batches(docs: DataFrame, keys: list[str], total_bytes: int) -> tuple[DataFrame, int]:
    """Deal rows to batches by the hash of the named columns; batches share as many partitions as the session shuffles to.

    Which batch a row belongs to depends on its values alone, so every later pass, and every retry after a
    lost executor, finds the same rows in the same batch.
    """
    n = batch_count(total_bytes)
    dealt = docs.withColumn(BATCH, F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
    return dealt.repartition(min(n, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), BATCH), n


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame of rows that the driver holds. Its size is known to the planner, which broadcasts it only below its threshold."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kind.fields)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow), kind)


@functools.cache
def _libc():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return None


def trim() -> None:
    """Give freed memory back to the system: Python workers live on between groups, tasks and stages."""
    pa.default_memory_pool().release_unused()
    if _libc():
        _libc()(0)


def _after(out):
    trim()
    return out


def lean(f: Callable) -> Callable:
    """f, of one table or two, with freed memory given back after each call."""
    if f.__code__.co_argcount == 1:
        return lambda table: _after(f(table))
    return lambda left, right: _after(f(left, right))
