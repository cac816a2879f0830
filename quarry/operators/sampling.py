"""Sampling, splitting, shuffling, sharding and mixing by ordinals and hashes; every result repeats for the same seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.preprocess import ordinal


#: Slots of interleave() that one task numbers.
SLOT_RUN = 1 << 16


def shuffle_key(seed: int, key: str | Column) -> Column:
    """The md5 of seed and key: its order is the shuffled order, in any engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), (F.col(key) if isinstance(key, str) else key).cast("string")))


def shuffled(df: DataFrame, key: str, seed: int = 42, name: str = "ordinal") -> DataFrame:
    """Number rows in shuffled order."""
    return ordinal(df, shuffle_key(seed, key), key, name=name)


def sample(df: DataFrame, n: int, key: str, seed: int = 42, shuffle: bool = True) -> DataFrame:
    """n rows: whole copies in order, then the rest from a permutation (or the first ones). Appends `copy`."""
    size = df.count()
    if n == size or not size:
        return df.withColumn("copy", F.lit(0))
    whole, rest = divmod(n, size)
    copies = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(whole - 1)))) if whole else df.withColumn("copy", F.lit(0)).where("false")
    order = (shuffle_key(seed, key), F.col(key)) if shuffle else (F.col(key),)
    tail = df.orderBy(*order).limit(rest).withColumn("copy", F.lit(whole))
    return copies.unionByName(tail) if rest else copies


def split(df: DataFrame, ratio: float, key: str, seed: int = 42, n: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, val): max(int(min(size, n) * ratio), 1) rows of least hash validate; 0 gives none, 1 gives all."""
    size = df.count()
    n = size if n is None else n
    if ratio <= 0:
        return sample(df, n, key, seed), df.where("false")
    if ratio >= 1:
        if n > size:
            raise ValueError("a full validation split has no more rows than the source")
        return df.where("false"), sample(df, n, key, seed)
    val = max(int(min(size, n) * ratio), 1)
    ranked = shuffled(df, key, seed, "__rank")
    return sample(ranked.where(F.col("__rank") >= val).drop("__rank"), n - val, key, seed), ranked.where(F.col("__rank") < val).drop("__rank")


def take_skip(df: DataFrame, order: str, n: int, ratio: float) -> tuple[DataFrame, DataFrame]:
    """(train, val) of the first n rows: the first int(n * ratio) validate."""
    numbered = ordinal(df, order, name="__i").where(F.col("__i") < n)
    val = int(n * ratio)
    return numbered.where(F.col("__i") >= val).drop("__i"), numbered.where(F.col("__i") < val).drop("__i")


def shard(df: DataFrame, order: str, shards: int, strided: bool = False) -> DataFrame:
    """Append `shard`: contiguous runs of equal size (as near as can be), or every shards-th row."""
    numbered = ordinal(df, order)
    if strided:
        return numbered.withColumn("shard", F.col("ordinal") % shards)
    size = df.count()
    # Row i is in shard s where floor(s * size / shards) <= i.
    return numbered.withColumn("shard", F.floor(((F.col("ordinal") + 1) * shards - 1) / F.lit(max(size, 1))))


def batches(df: DataFrame, order: str, size: int, drop_last: bool = False) -> DataFrame:
    """Append `batch`, the number of the run of `size` rows."""
    out = ordinal(df, order).withColumn("batch", F.floor(F.col("ordinal") / size))
    if not drop_last:
        return out
    return out.where(F.col("batch") < F.lit(df.count() // size))


def length_groups(df: DataFrame, key: str, length: str, batch: int, seed: int = 42, mega: int = 50) -> DataFrame:
    """Append `position`: shuffled runs of mega * batch rows, longest first within each run."""
    run = shuffled(df, key, seed).withColumn("run", F.floor(F.col("ordinal") / (mega * batch)))
    w = Window.partitionBy("run").orderBy(F.desc(length), "ordinal")
    return run.withColumn("position", F.col("run") * (mega * batch) + F.row_number().over(w) - 1).drop("ordinal")


def interleave(sources: list[DataFrame], weights: list[float], key: str, seed: int = 42, stop: str = "first_exhausted") -> DataFrame:
    """Draw a source for each output slot by hash, rows in order of `key` within each source. Appends slot and source.

    first_exhausted ends before the first slot whose source has no row left; all_exhausted ends when every source
    has been used up and starts shorter ones anew meanwhile.
    """
    if stop not in ("first_exhausted", "all_exhausted"):
        raise ValueError(stop)
    spark = sources[0].sparkSession
    sizes = [s.count() for s in sources]
    if not all(sizes):
        return sources[0].withColumns({"slot": F.lit(0).cast("long"), "source": F.lit(0)}).where("false")
    total, bounds = sum(weights), []
    for w in weights:
        bounds.append((bounds[-1] if bounds else 0) + w / total)
    # Enough slots that each source runs out: its expected number, and ten deviations more.
    n = max(int(s / (w / total) + 10 * (s ** 0.5) / (w / total) + 100) for s, w in zip(sizes, weights, strict=True))
    u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("slot").cast("string"))), 1, 8), 16, 10).cast("double") / 4294967296.0
    source = F.lit(len(sources) - 1)
    for i in range(len(sources) - 2, -1, -1):
        source = F.when(u < bounds[i], i).otherwise(source)
    slots = spark.range(n).select(F.col("id").alias("slot")).withColumn("source", source)
    # Slots of a source before each run of SLOT_RUN slots, then a slot's place within its run.
    slots = slots.withColumn("__run", F.floor(F.col("slot") / SLOT_RUN))
    upto = Window.partitionBy("source").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    runs = slots.groupBy("source", "__run").count().select("source", "__run", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("__before"))
    here = F.row_number().over(Window.partitionBy("source", "__run").orderBy("slot"))
    drawn = slots.withColumn("__here", here).join(runs, ["source", "__run"]).select("slot", "source", (F.col("__before") + F.col("__here") - 1).alias("nth"))
    size = F.element_at(F.array(*[F.lit(s) for s in sizes]), F.col("source") + 1)
    ends = drawn.where(F.col("nth") == (size if stop == "first_exhausted" else size - 1)).agg((F.min("slot") if stop == "first_exhausted" else F.max("slot") + 1).alias("end"))
    end = ends.first()["end"]
    drawn = drawn.where(F.col("slot") < F.lit(end)).withColumn("nth", F.col("nth") % size)
    rows = None
    for i, s in enumerate(sources):
        one = ordinal(s, key, name="nth").withColumn("source", F.lit(i))
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    return drawn.join(rows, ["source", "nth"]).drop("nth")


def concat(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; missing columns are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dynamic_groups(df: DataFrame, group: str, value: str, limit: int, *order: str) -> DataFrame:
    """Rows of groups whose values vary, the first `limit` rows by `order`; all rows where no group varies."""
    w = Window.partitionBy(group)
    varied = df.withColumn("__sd", F.coalesce(F.stddev_samp(value).over(w), F.lit(0.0)))
    kept = varied.where("__sd > 0").drop("__sd")
    return df if kept.isEmpty() else kept.orderBy(*order).limit(limit)


def resample(df: DataFrame, valid: str, order: str, required: int) -> DataFrame:
    """The first `required` valid rows by order; RuntimeError where there are fewer."""
    out = df.where(F.col(valid)).orderBy(order).limit(required)
    if (n := out.count()) < required:
        raise RuntimeError(f"{n} valid rows of {required}")
    return out


def negatives(df: DataFrame, pool: DataFrame, key: str, own: str, value: str, k: int, seed: int = 42) -> DataFrame:
    """(key, negative, nth): k values of the pool for each row, none of the row's own.

    The pool is put in shuffled order; a row begins at a place given by its hash and walks on, far enough to step
    over its own values. So each row reads a bounded run of the pool instead of all of it.
    """
    size = pool.select(value).distinct().count()
    if not size:
        return df.select(key, F.lit(None).cast("string").alias("negative"), F.lit(0).alias("nth")).where("false")
    numbered = shuffled(pool.select(value).distinct(), value, seed, "place").withColumnRenamed(value, "negative")
    start = F.pmod(F.conv(F.substring(shuffle_key(seed, key), 1, 8), 16, 10).cast("long"), F.lit(size))
    walk = df.select(key, own, F.explode(F.sequence(F.lit(0), F.least(F.lit(size - 1), F.size(own) + F.lit(k - 1)))).alias("step"), start.alias("start"))
    met = walk.withColumn("place", (F.col("start") + F.col("step")) % size).join(numbered, "place").where(~F.array_contains(own, F.col("negative")))
    w = Window.partitionBy(key).orderBy("step")
    return met.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k).select(key, "negative", "nth")


def hard_negatives(parts: Column, key: str | Column, h: int, seed: int = 42) -> Column:
    """(anchor, positive, negatives...) with exactly h negatives: cut to the first h, or padded by seeded repeats.

    Repeats are drawn from places 1 to n of the array for n negatives, as the usual tool does: the positive and all
    negatives but the last. Without a negative there is an error.
    """
    n = F.size(parts) - 2
    slot = lambda i: F.pmod(F.conv(F.substring(shuffle_key(seed, F.concat_ws(":", (F.col(key) if isinstance(key, str) else key).cast("string"), i.cast("string"))), 1, 8), 16, 10).cast("long"), n).cast("int")
    padded = F.concat(parts, F.transform(F.sequence(n, F.lit(h - 1)), lambda i: F.get(parts, slot(i) + 1)))
    return F.when(n < 1, F.raise_error(F.lit("no hard negative"))).when(n >= h, F.slice(parts, 1, h + 2)).otherwise(padded)
