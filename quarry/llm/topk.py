"""Exact top-k search by inner product with vector-approximation files.

Every vector becomes integers, floor(SCALE * x), and each component falls in one of 2**BITS cells whose edges are
quantiles of a bounded sample of vectors (any edges give exact results; good ones only save reading).

1. The approximation file: one byte a component, an eighth of the exact values, written once in blocks of an Arrow
   batch each.  Equal vectors of a block are kept for their k + 1 least ids only; no more can be among the k best.
2. A first scan of that file bounds each score from both sides: the query times the centres of the cells, give or take
   its absolute values times half their widths.  The kth best lower bound of a query, over all blocks, is a threshold.
3. A second scan lists what may be among the k best: rows whose upper bound reaches the threshold.
4. Exact vectors are read for those alone, in order of the upper bound: first FIRST_READS * k rows a query, then those
   whose upper bound reaches the kth exact score found.

Scans pair parts of the file with groups of queries; what travels is the file, once for each QUERY_ROWS queries, and
the queries, once for each PART_ROWS vectors.  Nothing that grows is broadcast.

Ties go to the smaller vec_id, then repeated rows count one by one.  Vectors that are null, empty, or hold null or
non-finite components take no part, nor do null ids; vectors of another length than the query's are no candidates.
Products are exact up to scores of 2**53.  An empty table, or no query, gives an empty result; other columns take no
part, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.cluster import checkpointed, lean, trim

SCALE = 256
K = 5
BITS = 8
#: Rows of the sample for cell edges; vectors of a part of the file and queries of a group, on average.
EDGE_ROWS = 4096
PART_ROWS = 16_384
QUERY_ROWS = 1024
#: Exact vectors that are read at first for a query, times k.
FIRST_READS = 2

FILE = "dims int, n long, ids binary, codes binary, low binary, high binary"


def usable(df: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, v array<double>): integer vectors of the rows that take part."""
    x = F.col(vector)
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double"))
    return df.where(F.coalesce(fine, F.lit(False)) & F.col(vec_id).isNotNull()).select(F.col(vec_id).alias("id"), v.alias("v"))


def cell_edges(sample: np.ndarray, bits: int = BITS) -> np.ndarray:
    """(2**bits - 1, dims) inner edges of the cells of each component."""
    return np.quantile(sample, np.arange(1, 1 << bits) / (1 << bits), axis=0)


def cells(v: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Cell of each component: c where edges[c - 1] <= x < edges[c]."""
    code = np.empty(v.shape, np.uint8)
    for d in range(v.shape[1]):
        code[:, d] = np.searchsorted(edges[:, d], v[:, d], "right")
    return code


def bounds(q: np.ndarray, code: np.ndarray, edges: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(queries, vectors) lower and upper bounds of inner products. low, high: least and greatest value of each component in the block."""
    cols = np.arange(code.shape[1])
    lo, hi = np.vstack([low, edges])[code, cols], np.vstack([edges, high])[code, cols]
    middle, reach = q @ ((lo + hi) / 2).T, np.abs(q) @ ((hi - lo) / 2).T
    # Bounds are sums in floating point; a margin keeps them on the safe side.
    reach += 1e-9 * (np.abs(q) @ np.maximum(np.abs(lo), np.abs(hi)).T) + 1e-6
    return middle - reach, middle + reach


def least_of_equal(ids: np.ndarray, v: np.ndarray, most: int) -> np.ndarray:
    """Rows of which fewer than `most` equal vectors have a smaller id (or the same, further up)."""
    if not len(ids):
        return np.zeros(0, np.int64)
    order = np.lexsort((ids, *v.T[::-1]))
    new = np.ones(len(ids), bool)
    new[1:] = (v[order[1:]] != v[order[:-1]]).any(1)
    first = np.flatnonzero(new)
    place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
    return np.sort(order[place < most])


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """ids and vectors of the rows of each length."""
    size = pa.compute.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
    for dims in np.unique(size).tolist():
        pick = np.flatnonzero(size == dims)
        yield np.asarray(batch.column(0))[pick], np.asarray(batch.column(1).take(pa.array(pick)).flatten()).reshape(len(pick), dims)


def approximation_file(rows: DataFrame, edges: dict[int, np.ndarray], k: int) -> DataFrame:
    """FILE rows of rows (id, v), one for each Arrow batch and length of vectors."""
    shared = rows.sparkSession.sparkContext.broadcast(edges)  # from a bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids, v in _matrices(batch):
                pick = least_of_equal(ids, v, k + 1)
                ids, v = ids[pick], v[pick]
                dims = v.shape[1]
                code = cells(v, shared.value.get(dims, np.zeros((0, dims))))
                out.append((dims, len(ids), ids.tobytes(), code.tobytes(), v.min(0).tobytes(), v.max(0).tobytes()))
            kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names=["dims", "n", "ids", "codes", "low", "high"])
        trim()

    return checkpointed(rows.select("id", "v").mapInArrow(run, FILE))


def survivors(file: DataFrame, asked: DataFrame, edges: dict[int, np.ndarray], k: int, part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, id, upper) of all rows of the file whose upper bound reaches the query's kth best lower bound."""
    n, m = int(file.agg(F.sum("n")).first()[0] or 0), asked.count()
    n_parts, n_groups = max(1, math.ceil(n / part_rows)), max(1, math.ceil(m / QUERY_ROWS))
    shared = file.sparkSession.sparkContext.broadcast(edges)
    left = file.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(n_parts)).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))

    def dealt(queries: DataFrame) -> DataFrame:
        return queries.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(n_groups)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))

    def scanned(blocks: pa.Table, queries: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
        """Places of the queries, their vectors' ids, and lower and upper bounds, the query's own row left out."""
        size = pa.compute.list_value_length(queries["v"]).to_numpy()
        every = np.asarray(queries["id"])
        for b in blocks.to_pylist():
            at = np.flatnonzero(size == b["dims"])
            if len(at):
                q = np.asarray(queries["v"].combine_chunks().take(pa.array(at)).flatten()).reshape(len(at), b["dims"])
                ids, low, high = np.frombuffer(b["ids"], np.int64), np.frombuffer(b["low"]), np.frombuffer(b["high"])
                code = np.frombuffer(b["codes"], np.uint8).reshape(-1, b["dims"])
                lower, upper = bounds(q, code, shared.value.get(b["dims"], np.zeros((0, b["dims"]))), low, high)
                own = every[at][:, None] == ids[None, :]
                lower[own] = upper[own] = -np.inf
                yield at, ids, lower, upper

    def least(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        """The k best lower bounds of each query in this part."""
        best = np.full((len(queries), k), -np.inf)
        for at, _, lower, _ in scanned(blocks, queries):
            both = np.concatenate([best[at], lower], axis=1)
            best[at] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        some = np.argwhere(best > -np.inf)
        return pa.table({"id": np.asarray(queries["id"])[some[:, 0]], "bound": best[some[:, 0], some[:, 1]]})

    def reach(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        """Rows whose upper bound reaches the threshold."""
        out, q_ids, least = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]], np.asarray(queries["id"]), queries["least"].to_numpy()
        for at, ids, _, upper in scanned(blocks, queries):
            hit = np.argwhere((upper >= least[at][:, None]) & (upper > -np.inf))
            for column, value in zip(out, (q_ids[at[hit[:, 0]]], ids[hit[:, 1]], upper[hit[:, 0], hit[:, 1]]), strict=True):
                column.append(value)
        return pa.table(dict(zip(("query_id", "id", "upper"), map(np.concatenate, out), strict=True)))

    keys = ("group", "part")
    found = left.groupBy(*keys).cogroup(dealt(asked).groupBy(*keys)).applyInArrow(lean(least), "id long, bound double")
    kth = found.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("bound")))).where(F.col("r") <= k).groupBy("id").agg(F.when(F.count(F.lit(1)) == k, F.min("bound")).alias("least"))
    ready = checkpointed(asked.join(kth, "id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf")))))
    return left.groupBy(*keys).cogroup(dealt(ready).groupBy(*keys)).applyInArrow(lean(reach), "query_id long, id long, upper double")


def top_k(base: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = SCALE, part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows of base for each row of queries, other than those of its own id."""
    rows = usable(base, vec_id, vector, scale)
    asked = usable(queries, vec_id, vector, scale).groupBy("id").agg(F.min("v").alias("v"))  # a repeated query id asks once
    sample = rows.orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(EDGE_ROWS).select("v").collect()
    edges = {d: cell_edges(np.array([r["v"] for r in sample if len(r["v"]) == d])) for d in {len(r["v"]) for r in sample}}
    del sample
    some = survivors(approximation_file(rows, edges, k), asked, edges, k, part_rows).distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("upper"), "id")
    listed = checkpointed(some.withColumn("r", F.row_number().over(order)))
    named = asked.select(F.col("id").alias("query_id"), F.col("v").alias("q"))

    def read(wanted: DataFrame) -> DataFrame:
        met = wanted.select("query_id", "id").join(rows, "id").join(named, "query_id").where(F.size("v") == F.size("q"))
        return met.select("query_id", F.col("id").alias("vec_id"), F.aggregate(F.zip_with("v", "q", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x).cast("long").alias("score"))

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = checkpointed(read(listed.where(F.col("r") <= FIRST_READS * k)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
    kth = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    rest = listed.where(F.col("r") > FIRST_READS * k).join(kth, "query_id", "left").where(F.col("kth").isNull() | (F.col("upper") >= F.col("kth")))
    every = first.drop("rank").union(read(rest))
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_top_k(spark, sf_dir: str) -> DataFrame:
    """The five nearest other vectors of every 50th vector."""
    base = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(base, base.where(F.col("vec_id") % 50 == 0))


#: The same over DuckDB.
OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
