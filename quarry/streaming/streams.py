"""Structured Streaming: the same column expressions over files as they arrive, and stateful packing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarry.operators.packing import next_fit
from quarry.shared import removed, shared_folder

#: Rows that a key's packing state may hold before it is packed.
INTERVAL = 128
PACKED = "pack_key string, row_ids array<long>, length long"


def read_stream(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """New files of a folder; the schema is given, as streams infer none."""
    reader = spark.readStream.format("json" if kind == "jsonl" else kind).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def take_skip(df: DataFrame, ordinal: str, n: int, ratio: float) -> tuple[DataFrame, DataFrame]:
    """(train, val) by the rows' own ordinals, so that restarts split alike."""
    val = int(n * ratio)
    inside = df.where(F.col(ordinal) < n)
    return inside.where(F.col(ordinal) >= val), inside.where(F.col(ordinal) < val)


def union_streams(streams: list[DataFrame], tag: str = "dataset") -> DataFrame:
    out = streams[0].withColumn(tag, F.lit(0))
    for i, s in enumerate(streams[1:], 1):
        out = out.unionByName(s.withColumn(tag, F.lit(i)), allowMissingColumns=True)
    return out


def each_batch_shuffled(df: DataFrame, key: str, seed: int, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand every micro-batch to the sink in hash order."""

    def one(batch: DataFrame, number: int) -> None:
        sink(batch.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))), number)

    return df.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).start()


def packed_stream(df: DataFrame, pack_key: str, row: str, length: str, cap: int, interval: int = INTERVAL) -> DataFrame:
    """PACKED rows: by key, rows are packed in order of arrival; the open bin stays in the state.

    The state of a key is its open bin, which holds less than `cap`. open_bins() reads what waits there when input ends.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rows, sizes = state.get if state.exists else ([], [])
        carry = list(zip(rows, sizes, strict=True))
        items: list[tuple[int, int]] = []
        for b in batches:
            items += list(zip(b["row"].tolist(), b["n"].tolist(), strict=True))
        out: list[list[tuple[int, int]]] = []
        items.sort()
        for at in range(0, len(items), interval):
            bins = list(next_fit(items[at : at + interval], cap, carry))
            open_ = bins and sum(n for _, n in bins[-1]) < cap
            carry = bins.pop() if open_ else []
            out += bins
        state.update(([r for r, _ in carry], [n for _, n in carry]))
        yield pd.DataFrame({"pack_key": [key[0]] * len(out), "row_ids": [[r for r, _ in b] for b in out], "length": [sum(n for _, n in b) for b in out]})

    slim = df.select(F.col(pack_key).cast("string").alias("k"), F.col(row).cast("long").alias("row"), F.col(length).cast("long").alias("n"))
    return slim.groupBy("k").applyInPandasWithState(step, PACKED, "rows array<long>, sizes array<long>", "append", "NoTimeout")


def open_bins(spark: SparkSession, checkpoint: str) -> DataFrame:
    """PACKED rows of the bins that a packed_stream which has ended holds in the state of its checkpoint."""
    bins = spark.read.format("statestore").load(checkpoint).select(F.col("key.k").alias("pack_key"), F.col("value.groupState.rows").alias("row_ids"), F.col("value.groupState.sizes").alias("sizes"))
    return bins.where(F.size("row_ids") > 0).select("pack_key", "row_ids", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n).alias("length"))


def run_packed(df: DataFrame, name: str, pack_key: str, row: str, length: str, cap: int) -> DataFrame:
    """packed_stream over what is there, to the end, with the open bin of every key at last."""
    spark = df.sparkSession
    packs = run_all(packed_stream(df, pack_key, row, length, cap), name)
    return packs.unionByName(open_bins(spark, f"{shared_folder(spark)}/{name}/state"))


def event_counts(df: DataFrame, time: str, late: str, window: str, *keys: str) -> DataFrame:
    """Counts by window and keys; rows later than `late` are dropped."""
    return df.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count(F.lit(1)).alias("n"))


def run_all(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Read what is there to the end, into Parquet files of the shared folder; mode complete keeps the last result.

    Files and state lie in a folder of the given name, which goes when the session's JVM ends.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{name}"
    removed(spark, folder, now=False)
    out = f"{folder}/rows"
    spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{out}/batch=-1")

    def put(batch: DataFrame, number: int) -> None:
        # A batch that runs again writes over what it wrote before.
        batch.write.mode("overwrite").parquet(f"{out}/batch={0 if mode == 'complete' else number}")

    df.writeStream.foreachBatch(put).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{folder}/state").start().awaitTermination()
    return spark.read.schema(df.schema).option("basePath", out).parquet(f"{out}/*").select(*df.columns)
