"""Connected components of a graph given as a DataFrame of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.cluster import checkpointed, local_frame

#: A key is hot if it has more than one in HOT_SHARE of all rows, so there are fewer hot keys than that.
HOT_SHARE = 1000
#: Parts into which the rows of a hot key are dealt.
HOT_PARTS = 64


def looked_up(rows: DataFrame, key: str, table: DataFrame, rest: str) -> DataFrame:
    """rows joined with table, which has one row for each `key`, a long; rows of hot keys are dealt by the hash of `rest`.

    Hot keys are found by a count; fewer than HOT_SHARE keys can be hot, so the driver may hold them.  Their rows of
    table are copied HOT_PARTS times.
    """
    counts = rows.groupBy(key).count()
    total = int(counts.agg(F.sum("count")).first()[0] or 0)
    hot = [(r[0], 1) for r in counts.where(F.col("count") > max(100, total // HOT_SHARE)).select(key).collect()]
    if not hot:
        return rows.join(table, key)
    marks = local_frame(rows.sparkSession, hot, f"{key} long, __hot int")
    salt = F.when(F.col("__hot") == 1, F.pmod(F.xxhash64(rest), F.lit(HOT_PARTS))).otherwise(0).cast("int")
    parts = F.when(F.col("__hot") == 1, F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(F.broadcast(marks), key, "left").withColumn("__salt", salt).drop("__hot")
    right = table.join(F.broadcast(marks), key, "left").withColumn("__salt", F.explode(parts)).drop("__hot")
    return left.join(right, [key, "__salt"]).drop("__salt")


def forests(edges: DataFrame) -> DataFrame:
    """(a, b): of each Arrow batch of edges, one edge from each node to the least node of its component there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1))])
            ids, at = np.unique(ends, return_inverse=True)
            at = at.reshape(2, -1)
            f = Forest(len(ids))
            for i, j in zip(at[0].tolist(), at[1].tolist(), strict=True):
                f.join(i, j)
            root = f.roots()
            far = np.flatnonzero(root != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[root[far]])], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the least id reachable from each id of edges (a long, b long).

    Edges are first cut to forests, batch by batch.  Then each round takes the least label of the neighbours, then the
    label of the label, so that distances at least halve and rounds are about the logarithm of the longest of them.
    Neighbours of a hub and members of a large component are dealt to many tasks.  Every round is written to the
    checkpoint folder; it ends when no label changes.
    """
    alone = edges.where("a = b").select(F.col("a").alias("id"))
    slim = checkpointed(forests(edges.where("a <> b")).distinct())
    both = slim.union(slim.select(F.col("b"), F.col("a")))
    labels = checkpointed(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("a"), F.min("b")).alias("comp")))
    while True:
        near = looked_up(both, "b", labels.select(F.col("id").alias("b"), F.col("comp").alias("c")), "a").groupBy(F.col("a").alias("id")).agg(F.min("c").alias("c"))
        hooked = checkpointed(labels.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "c").alias("comp")))
        after = checkpointed(looked_up(hooked, "comp", hooked.select(F.col("id").alias("comp"), F.col("comp").alias("up")), "id").select("id", "old", F.least("comp", "up").alias("comp")))
        labels = after.select("id", "comp")
        if after.where("comp <> old").isEmpty():
            return labels.union(alone.join(labels, "id", "left_anti").distinct().select("id", F.col("id").alias("comp")))


class Forest:
    """Union-find over the numbers 0 to n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))], np.int64)
