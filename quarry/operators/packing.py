"""Packing rows into bins of bounded length."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a packing shard on average: a shard is packed by one task. Packs of best_fit do not cross shards.
SHARD_ROWS = 100_000
PACKS = "shard int, pack_id int, row_ids array<long>, length long"


def best_fit(items: Iterable[tuple[int, int]], cap: int) -> list[list[tuple[int, int]]]:
    """Best-fit decreasing: longest first, each into the fullest bin that has room. An item above cap has a bin of its own."""
    import bisect

    room: list[tuple[int, int]] = []  # (free, bin), sorted
    bins: list[list[tuple[int, int]]] = []
    for row, length in sorted(items, key=lambda x: (-x[1], x[0])):
        at = bisect.bisect_left(room, (length, -1))
        if at < len(room):
            free, b = room.pop(at)
            bins[b].append((row, length))
        else:
            free, b = max(cap, length), len(bins)
            bins.append([(row, length)])
        if free - length > 0:
            bisect.insort(room, (free - length, b))
    return bins


def next_fit(items: Iterable[tuple[int, int]], cap: int, carry: list[tuple[int, int]] | None = None) -> Iterator[list[tuple[int, int]]]:
    """In order: a bin closes before it would overflow, and once it is full. The open bin comes last."""
    now, size = list(carry or []), sum(x[1] for x in carry or [])
    for row, length in items:
        if now and size + length > cap:
            yield now
            now, size = [], 0
        now.append((row, length))
        size += length
        if size >= cap:
            yield now
            now, size = [], 0
    if now:
        yield now


def passage(lengths: np.ndarray, cap: int) -> list[tuple[int, bool, int, int]]:
    """How next_fit leaves these rows, by the size of the open bin that it brings (-1: none).

    Runs of sizes, each as (least size, whether the exit grows with the size, exit size, bins closed).
    """
    m = len(lengths)
    upto = np.concatenate([[0], np.cumsum(lengths)])

    def cut(room: np.ndarray) -> np.ndarray:
        """Where a bin ends that is full where `upto` is `room`: before the row that overflows it; m + 1 if it stays open."""
        e = np.searchsorted(upto, room, "left")
        return np.where(e > m, m + 1, np.where(upto[np.minimum(e, m)] > room, e - 1, e))

    after = np.maximum(cut(upto[:-1] + cap), np.arange(1, m + 1)).tolist()
    left, closed = [-1] * (m + 1), [0] * (m + 1)
    for i in range(m - 1, -1, -1):
        j = after[i]
        left[i], closed[i] = (int(upto[m] - upto[i]), 0) if j > m else (left[j], closed[j] + 1)
    first = cut(cap - np.arange(cap))
    out = [(-1, False, left[0], closed[0])]
    for size in np.flatnonzero(np.diff(first, prepend=-1)).tolist():
        p = int(first[size])
        out.append((size, True, int(upto[m]), 0) if p > m else (size, False, left[p], closed[p] + 1))
    return out


def _next_fit_across(dealt: DataFrame, cap: int) -> DataFrame:
    """PACKS of next_fit over all shards in order, numbered through; `shard` is that of a pack's first row.

    Each shard says how it would leave every size of open bin that may come (`passage`, at most a run for each row of
    its first bin); the driver walks those from shard to shard; shards then pack from the size that comes.
    """

    def ways(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        runs = passage(rows.sort_values(["row", "n"])["n"].to_numpy(), cap)
        return pd.DataFrame([(key[0], *r) for r in runs], columns=["shard", "least", "grows", "size", "closed"])

    enters: dict[int, tuple[int, int]] = {}
    size, base = -1, 0
    found: dict[int, list] = {}
    for r in dealt.groupBy("shard").applyInPandas(ways, "shard int, least long, grows boolean, size long, closed long").collect():
        found.setdefault(r["shard"], []).append((r["least"], r["grows"], r["size"], r["closed"]))
    for shard in sorted(found):
        enters[shard] = size, base
        _, grows, left, closed = max(x for x in found[shard] if x[0] <= size)
        size, base = size + left if grows else left, base + closed

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["row", "n"])
        size, base = enters[key[0]]
        bins = list(next_fit(zip(rows["row"], rows["n"], strict=True), cap, [(None, size)] if size >= 0 else None))
        if size >= 0:
            bins[0] = bins[0][1:]
        got = [(base + i, b) for i, b in enumerate(bins) if b]
        return pd.DataFrame({"shard": key[0], "pack_id": [i for i, _ in got], "row_ids": [[r for r, _ in b] for _, b in got], "length": [sum(n for _, n in b) for _, b in got]})

    pieces = dealt.groupBy("shard").applyInPandas(run, PACKS).groupBy("pack_id")
    whole = pieces.agg(F.min("shard").alias("shard"), F.array_sort(F.collect_list(F.struct("shard", "row_ids"))).alias("p"), F.sum("length").alias("length"))
    return whole.select("shard", "pack_id", F.flatten("p.row_ids").alias("row_ids"), "length")


def pack(df: DataFrame, row: str, length: str, cap: int, method: str = "best_fit", shards: int | None = None) -> DataFrame:
    """PACKS rows. Rows are dealt to shards by contiguous order (next_fit, which goes on across them) or by hash (best_fit)."""
    from quarry.operators.preprocess import ordinal

    if method not in ("best_fit", "next_fit"):
        raise ValueError(method)
    shards = shards or max(1, -(-df.count() // SHARD_ROWS))
    slim = df.select(F.col(row).cast("long").alias("row"), F.col(length).cast("long").alias("n"))
    if method == "best_fit":
        dealt = slim.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    elif shards == 1:
        dealt = slim.withColumn("shard", F.lit(0))
    else:
        size = max(1, df.count())
        dealt = ordinal(slim, "row", "n").withColumn("shard", F.floor(F.col("ordinal") * shards / size).cast("int"))
        return _next_fit_across(dealt.select("shard", "row", "n"), cap)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        items = list(zip(rows["row"], rows["n"], strict=True))
        bins = best_fit(items, cap) if method == "best_fit" else list(next_fit(items, cap))
        return pd.DataFrame({"shard": key[0], "pack_id": range(len(bins)), "row_ids": [[r for r, _ in b] for b in bins], "length": [sum(n for _, n in b) for b in bins]})

    return dealt.select("shard", "row", "n").groupBy("shard").applyInPandas(run, PACKS)


def packed_rows(packs: DataFrame, rows: DataFrame, row: str, ids: str = "input_ids", labels: str = "labels") -> DataFrame:
    """(shard, pack_id, input_ids, labels, position_ids, lengths) of each pack, rows in the pack's order."""
    from quarry.functions.arrays import position_ids

    placed = packs.select("shard", "pack_id", F.posexplode("row_ids").alias("i", "__row")).join(rows.select(F.col(row).alias("__row"), ids, labels), "__row")
    got = placed.groupBy("shard", "pack_id").agg(F.array_sort(F.collect_list(F.struct("i", ids, labels))).alias("p"))
    sizes = F.transform("p", lambda x: F.size(x[ids]))
    return got.select("shard", "pack_id", F.flatten(F.transform("p", lambda x: x[ids])).alias(ids), F.flatten(F.transform("p", lambda x: x[labels])).alias(labels), position_ids(sizes).alias("position_ids"), sizes.alias("lengths"))
