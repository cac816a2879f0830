"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. targets(): the words that each source gives to the mix, by weight, held at `max_epochs` times its size.
2. Every source is cut into blocks by the leading bits of a seeded hash of its rows, which is also their random
   order.  A source gives whole epochs, then its first blocks up to the quota, then part of the block at which
   the quota ends.  That block is cut again by the next bits of the hash until it holds few rows, and the rows
   that fit the rest are taken from the largest down.
3. split_quotas(): a binary tree over the output shards.  At each node the exact vector of block quotas is split
   between the two halves by a multivariate hypergeometric draw, so quotas add up at every level and each shard
   gets a random, unequal share of each source.
4. A shard draws disjoint runs of the permuted blocks of each source and shuffles what it drew by itself.

Blocks and rows stay in DataFrames.  Hot sources have many blocks: up to SHARD_BLOCKS for each shard.

Repeated rows, equal in all columns, share one hash and so one place in the order.  They are one unit of several
rows: where only part of them fits, that many are taken, whichever; no order is needed among equal rows.

Nulls: a null text has size 0, a null source is a source of its own, last in order.  An empty table gives an empty
mix.  Extra columns pass through, except that mix() replaces those named like its own.  Columns must be hashable
(no maps).  The driver holds numbers for each source and, for each, of SHARDS shards: sources are named corpora,
some thousands at most.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.cluster import checkpointed, local_frame
from quarry.llm.rules import BLANK

#: Weights by the rank of the source, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SHARDS = 16
SEED = 20240607
#: Rows of a block on average, blocks of a source for each shard at most, and units of the last cut at most.
BLOCK_ROWS = 64
SHARD_BLOCKS = 16
LAST_ROWS = 512
#: Parts, as a power of two, in which a shard is sorted.
CELL_BITS = 6


def size_words(text: Column) -> Column:
    words = F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK + "+"), ""))
    return words.cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, budget: float | None = None, most: float = MAX_EPOCHS) -> np.ndarray:
    """Words that each source is to give. What sources cannot take beyond `most` times their size is shared by weight."""
    size = np.asarray(sizes, float)
    w = np.array([weights[i % len(weights)] for i in range(len(size))], float)
    rest, out, free = float(size.sum() if budget is None else budget), np.zeros(len(size)), np.ones(len(size), bool)
    while free.any():
        share = np.where(free, w, 0.0) * (rest / w[free].sum())
        over = free & (share > most * size)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = most * size[over]
        rest -= float(out[over].sum())
        free &= ~over
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources): exact block quotas of every shard; sums over shards are `quotas`."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    take = int(quotas.sum()) * left // shards
    drawn = rng.multivariate_hypergeometric(quotas, take, method="marginals") if take else np.zeros_like(quotas)
    return np.concatenate([split_quotas(drawn, left, rng), split_quotas(quotas - drawn, shards - left, rng)])


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, shards: int = SHARDS, seed: int = SEED, most: int = MAX_EPOCHS) -> DataFrame:
    """Append size, source_size, target, taken and draws to every row of docs; no row is repeated yet.

    draws: array<struct<shard int, position long>>, one element for each copy that the mix takes.
    """
    spark = docs.sparkSession
    new = ("size", "source_size", "target", "taken", "draws")
    whole = F.xxhash64(F.lit(seed), *docs.drop(*new).columns)
    rows = docs.drop(*new).withColumns({"size": size_words(F.col(text)), "__s": F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("~")), "__h": whole})
    slim = checkpointed(rows.select("__s", "__h", "size"))
    # '~' is the null source: named ones begin with 's' and so come before it.
    stats = slim.groupBy("__s").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    stats.sort(key=lambda r: (r["__s"] == "~", r["__s"]))
    plan, quotas = [], []
    goal = targets([r["size"] for r in stats], weights, most=most)
    for r, t in zip(stats, goal, strict=True):
        blocks = 1
        while blocks < max(2, shards * SHARD_BLOCKS) and r["n"] > blocks * BLOCK_ROWS:
            blocks *= 2
        epochs = int(t // r["size"]) if r["size"] else 0
        plan.append({"s": r["__s"], "size": int(r["size"]), "n": r["n"], "target": float(t), "bits": blocks.bit_length() - 1, "epochs": epochs, "rest": int(round(t - epochs * r["size"]))})
        quotas.append(0)
    schema = "__s string, source_size long, target double, __bits int, __epochs int, __rest long"
    source_rows = local_frame(spark, [(p["s"], p["size"], p["target"], p["bits"], p["epochs"], p["rest"]) for p in plan], schema)

    block = F.expr("CASE WHEN __bits > 0 THEN shiftrightunsigned(__h, 64 - __bits) ELSE 0L END")
    placed = rows.join(source_rows, "__s").withColumn("__b", block)
    small = slim.join(source_rows, "__s").withColumn("__b", block)
    sums = small.groupBy("__s", "__b").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.first("__rest").alias("rest"), F.first("__bits").alias("bits"))
    order = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sums.withColumn("upto", F.sum("words").over(order))
    # Blocks of the last, partial epoch: those that fit as a whole, and the one at which the quota ends.
    edge = ranked.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest")))
    edges = {r["__s"]: r for r in edge.collect()}
    for i, p in enumerate(plan):
        e = edges.get(p["s"])
        p["full"] = int(e["__b"]) if e else (1 << p["bits"])
        quotas[i] = p["epochs"] * (1 << p["bits"]) + p["full"] + (1 if e else 0)
    cells = {s: {"bits": e["bits"], "prefix": int(e["__b"]), "rest": int(e["rest"] - (e["upto"] - e["words"])), "n": e["n"]} for s, e in edges.items()}
    bounds: dict[str, list[int]] = {s: [] for s in cells}  # hashes below which the rows of the edge block are taken
    # Cut edge blocks of many rows again, all sources in one pass.
    while wide := {s: c for s, c in cells.items() if c["n"] > LAST_ROWS and c["bits"] < 60}:
        more = {s: min(12, max(1, int(np.ceil(np.log2(c["n"] / BLOCK_ROWS)))), 60 - c["bits"]) for s, c in wide.items()}
        frame = local_frame(spark, [(s, c["bits"], c["prefix"], more[s], c["rest"]) for s, c in wide.items()], "__s string, __bits int, __p long, __more int, rest long")
        inner = slim.join(frame, "__s").where(F.expr("(CASE WHEN __bits > 0 THEN shiftrightunsigned(__h, 64 - __bits) ELSE 0L END) = __p")).withColumn("__b", F.expr("shiftrightunsigned(__h, 64 - __bits - __more)"))
        units = inner.groupBy("__s", "__h", "__b").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
        sub = units.groupBy("__s", "__b").agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("n"), F.first("rest").alias("rest")).withColumn("upto", F.sum("words").over(order))
        found = {r["__s"]: r for r in sub.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest"))).collect()}
        for s in wide:
            r = found.get(s)
            if r is None:  # cannot be: the block holds more words than the rest
                cells[s]["n"] = 0
                continue
            before = cells[s]
            cells[s] = {"bits": before["bits"] + more[s], "prefix": int(r["__b"]), "rest": int(r["rest"] - (r["upto"] - r["words"])), "n": r["n"], "from": before.get("from", before["prefix"] << (64 - before["bits"]) if before["bits"] else 0)}
    # Units of the last cuts, from the largest row down while rows fit.
    part: list[tuple[str, int, int]] = []
    if cells:
        frame = local_frame(spark, [(s, c["bits"], c["prefix"], c["rest"]) for s, c in cells.items()], "__s string, __bits int, __p long, rest long")
        last = slim.join(frame, "__s").where(F.expr("(CASE WHEN __bits > 0 THEN shiftrightunsigned(__h, 64 - __bits) ELSE 0L END) = __p"))
        units = last.groupBy("__s", "__h").agg(F.first("size").alias("w"), F.count(F.lit(1)).alias("m"), F.first("rest").alias("rest"))
        fill = F.expr(
            "aggregate(array_sort(collect_list(struct(-w AS w, __h AS h, m AS m))), struct(first(rest) AS left, CAST(array() AS array<struct<h:bigint,k:bigint,m:bigint>>) AS hs), "
            "(acc, x) -> IF(x.w < 0 AND x.w + acc.left >= 0, struct(acc.left + x.w * least(x.m, acc.left div -x.w) AS left, array_append(acc.hs, struct(x.h AS h, least(x.m, acc.left div -x.w) AS k, x.m AS m)) AS hs), acc), acc -> acc.hs)"
        )
        extra = checkpointed(units.groupBy("__s").agg(fill.alias("hs")).select("__s", F.explode("hs").alias("x")).select("__s", F.col("x.h").alias("__h"), F.col("x.k").alias("__picked"), F.col("x.m").alias("__m")))
        part = [(r["__s"], r["__h"], r["__picked"]) for r in extra.where("__picked < __m").collect()]  # a few for each source
        extra = extra.drop("__m")
    else:
        extra = local_frame(spark, [], "__s string, __h long, __picked long")
    # The tree: runs of blocks of every shard.
    tree = split_quotas(np.array(quotas, np.int64), shards, np.random.default_rng(seed)) if plan else np.zeros((shards, 0), np.int64)
    upto = np.cumsum(tree, axis=0)
    runs = [[int(x) for x in upto[:, i]] for i in range(len(plan))]
    tail = [(p["s"], cells[p["s"]]["prefix"], cells[p["s"]]["bits"]) if p["s"] in cells else (p["s"], None, None) for p in plan]
    runs_schema = "__s string, __full long, __runs array<bigint>, __tail long, __tail_bits int"
    runs_rows = local_frame(spark, [(p["s"], p["full"], r, t[1], t[2]) for p, r, t in zip(plan, runs, tail, strict=True)], runs_schema)
    out = placed.join(runs_rows, "__s").join(extra, ["__s", "__h"], "left")
    if part:
        # Equal rows of which only some are taken are counted, and told apart by number.
        few = F.broadcast(local_frame(spark, [x[:2] for x in part], "__s string, __h long"))
        names = out.columns
        told = out.join(few, ["__s", "__h"], "left_semi").groupBy(*[c for c in names if c != "__runs"]).agg(F.first("__runs").alias("__runs"), F.count(F.lit(1)).alias("__n"))
        told = told.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).withColumn("__picked", F.when(F.col("__i") <= F.col("__picked"), F.col("__picked")))
        out = out.join(few, ["__s", "__h"], "left_anti").select(names).unionByName(told.select(names))
    # In the edge block, rows before the last cut are taken whole; those of the last cut only if picked.
    cell = F.expr("CASE WHEN __tail_bits > 0 THEN shiftrightunsigned(__h, 64 - __tail_bits) ELSE 0L END")
    in_rest = (F.col("__b") < F.col("__full")) | ((F.col("__b") == F.col("__full")) & F.coalesce((cell < F.col("__tail")) | F.col("__picked").isNotNull(), F.lit(False)))
    epochs = F.when(F.col("__epochs") > 0, F.sequence(F.lit(0), F.col("__epochs") - 1)).otherwise(F.array().cast("array<int>"))
    copies = F.when(in_rest, F.array_append(epochs, F.col("__epochs"))).otherwise(epochs)
    number = lambda e: e.cast("long") * F.expr("shiftleft(1L, __bits)") + F.col("__b")
    shard = lambda e: F.size(F.filter("__runs", lambda x: x <= number(e)))
    draws = F.transform(copies, lambda e: F.struct(shard(e).cast("int").alias("shard"), F.xxhash64(F.lit(seed + 1), "__h", e).alias("position")))
    return out.withColumn("draws", draws).withColumn("taken", F.size("draws") * F.col("size")).select(*docs.drop(*new).columns, "size", "source_size", "target", "taken", "draws")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it is drawn, with `shard` and `position`, shuffled within shards.

    Shards are dealt to partitions in CELLS parts each, by the leading bits of the position, and every partition is
    sorted by (shard, position): that order is the shuffle.  Columns of docs keep their values; only those named
    shard or position are replaced.
    """
    cols = [c for c in docs.columns if c not in ("shard", "position")]
    aside = {c: f"__own_{c}" for c in cols if c in ("size", "source_size", "target", "taken", "draws")}
    out = mix(docs.select(*cols).withColumnsRenamed(aside), **options).select(*[F.col(aside.get(c, c)).alias(c) for c in cols], F.explode("draws").alias("__d"))
    out = out.select(*cols, F.col("__d.shard").alias("shard"), F.col("__d.position").alias("position"))
    cell = F.expr(f"shiftrightunsigned(position, 64 - {CELL_BITS})")
    return out.repartition("shard", cell).sortWithinPartitions("shard", "position")


def op1_mix(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", "taken", F.transform("draws", lambda d: d["shard"]).alias("shards"))
