"""Rejection sampling: candidates per prompt, scores, the best and the worst of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-5


def replicated(df: DataFrame, n: int) -> DataFrame:
    """n requests for each prompt, numbered in `nth`."""
    return df.withColumn("nth", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def normalised(df: DataFrame, prompt: str, score: str, name: str) -> DataFrame:
    """Min-max in each prompt; where all are equal, 0 stays 0 and others are cut at 1."""
    w = Window.partitionBy(prompt)
    low, high = F.min(score).over(w), F.max(score).over(w)
    return df.withColumn(name, F.when(high - low > EPS, (F.col(score) - low) / (high - low + EPS)).when(F.col(score) == 0, 0.0).otherwise(F.least(F.lit(1.0), F.col(score))))


def list_reward(scores: Column) -> Column:
    """A list of step scores counts as its least."""
    return F.array_min(scores)


def selected(df: DataFrame, prompt: str, candidate: str, orm: str, prm: str, n: int, threshold: float = 0.0, easy: float | None = None) -> DataFrame:
    """The n best candidates of each prompt with the worst one as `rejected`.

    score = prm + 10 * orm. Best ones have an orm reward above the threshold and differ from the worst.
    Prompts without any are left out, and with `easy` those where int(N * easy) or more others are right.
    """
    w = Window.partitionBy(prompt)
    x = df.withColumns({"__score": F.col(prm) + 10 * F.col(orm), "__ok": F.col(orm) > threshold})
    worst = F.first(candidate).over(w.orderBy("__score", candidate))
    x = x.withColumns({"rejected": worst, "__right": F.sum(F.col("__ok").cast("int")).over(w), "__n": F.count(F.lit(1)).over(w)})
    if easy is not None:
        x = x.where(~(F.col("__right") - 1 >= F.floor((F.col("__n") - 1) * easy)))
    x = x.where(F.col("__ok") & (F.col(candidate) != F.col("rejected")))
    best = x.withColumn("rank", F.row_number().over(w.orderBy(F.desc("__score"), candidate))).where(F.col("rank") <= n)
    return best.drop("__score", "__ok", "__right", "__n")


def cached_choices(cache: DataFrame, key: str, choice: str) -> DataFrame:
    return cache.groupBy(key).agg(F.array_sort(F.collect_list(choice)).alias("choices"))


def distilled(thinking: Column, answer: Column) -> Column:
    return F.concat(F.lit("<think>"), thinking, F.lit("</think>\n\n<answer>"), answer, F.lit("</answer>"))


def whole_batches(df: DataFrame, order: str, size: int, done: int = 0) -> DataFrame:
    """Full batches after the first `done`; the tail that fills none is dropped. Appends `batch`."""
    from quarry.operators.sampling import batches

    return batches(df, order, size, drop_last=True).where(F.col("batch") >= done)
