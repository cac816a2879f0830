"""Evaluation metrics as aggregates over DataFrames."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.arrays import cosine, dot, euclidean, manhattan
from quarry.functions.scores import bleu, matched_iou, rouge_l, rouge_n


def mean_metric(value: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.avg(value.cast("double")), F.lit(empty))


def infer_stats(df: DataFrame, request: str, order: str, prompt: str, generated: str, seconds: float) -> DataFrame:
    """One row of token sums over the last row of each request, and rates per second."""
    last = df.groupBy(request).agg(F.max_by(prompt, order).alias("p"), F.max_by(generated, order).alias("g"))
    return last.agg(F.sum("p").alias("prompt_tokens"), F.sum("g").alias("generated_tokens"), F.count(F.lit(1)).alias("samples")).withColumns({"samples_per_s": F.col("samples") / seconds, "tokens_per_s": F.col("generated_tokens") / seconds})


def length_stats(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """mean, population deviation, min, max and number."""
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"), F.count(value).alias("size"))


def shifted_pairs(labels: Column, preds: Column, ignored: int = -100) -> Column:
    """Pairs of a label and the prediction made one token before; ignored labels are left out."""
    n = F.size(labels)
    z = F.arrays_zip(F.slice(labels, 2, F.greatest(n - 1, F.lit(0))).alias("l"), F.slice(preds, 1, F.greatest(n - 1, F.lit(0))).alias("p"))
    return F.filter(z, lambda x: x["l"] != ignored)


def token_accuracy(df: DataFrame, labels: str, preds: str) -> DataFrame:
    z = shifted_pairs(F.col(labels), F.col(preds))
    hits = F.size(F.filter(z, lambda x: x["l"] == x["p"]))
    return df.agg((F.sum(hits) / F.sum(F.size(z))).alias("token_acc"))


def sequence_accuracy(df: DataFrame, labels: str, preds: str) -> DataFrame:
    z = shifted_pairs(F.col(labels), F.col(preds))
    return df.agg(F.avg(F.forall(z, lambda x: x["l"] == x["p"]).cast("double")).alias("seq_acc"))


def exact_match(pred: Column, gold: Column) -> Column:
    return F.avg((pred == gold).cast("double"))


def overlap_scores(df: DataFrame, pred: str, ref: str) -> DataFrame:
    """One row: mean ROUGE-1, -2, -L F and BLEU-4 in percent, rows with an empty side left out."""

    @F.pandas_udf("rouge_1 double, rouge_2 double, rouge_l double, bleu_4 double")
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [(rouge_n(p, r, 1), rouge_n(p, r, 2), rouge_l(p, r), bleu(p, [r])) for p, r in ((x.split(), y.split()) for x, y in zip(a, b, strict=True))]
        return pd.DataFrame(rows, columns=["rouge_1", "rouge_2", "rouge_l", "bleu_4"])

    x = df.where((F.trim(pred) != "") & (F.trim(ref) != "")).select(run(F.col(pred), F.col(ref)).alias("s"))
    return x.agg(*[F.round(F.avg(f"s.{c}") * 100, 6).alias(c) for c in ("rouge_1", "rouge_2", "rouge_l", "bleu_4")])


def average_ranks(df: DataFrame, value: str, name: str, group: str) -> DataFrame:
    """Append ranks within each group, ties averaged; rows whose value is null are dropped.

    Distinct values are counted, numbered by ranges, and summed up in runs, so no task ranks all rows of a group.
    """
    from quarry.operators.preprocess import ordinal

    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("__n"))
    run = ordinal(counts, group, value, name="__i").withColumn("__r", F.floor(F.col("__i") / 1024))
    upto = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # one row for each 1024 distinct values
    before = run.groupBy("__r").agg(F.sum("__n").alias("__t")).select("__r", F.coalesce(F.sum("__t").over(upto), F.lit(0)).alias("__before"))
    inside = run.withColumn("__c", F.sum("__n").over(Window.partitionBy("__r").orderBy("__i"))).join(before, "__r").withColumn("__c", F.col("__c") + F.col("__before"))
    first = inside.groupBy(group).agg(F.min(F.col("__c") - F.col("__n")).alias("__first"))
    ranks = inside.join(first, group).select(group, value, (F.col("__c") - F.col("__first") - (F.col("__n") - 1) / 2).alias(name))
    return df.join(ranks, [group, value])


def paired_correlations(df: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """(measure, pearson, spearman) of four similarities of two vectors against a score; rows with a null score are left out."""
    x = df.select(F.col(label).cast("double").alias("y"), F.col(a).alias("a"), F.col(b).alias("b"))
    s = x.select("y", cosine(F.col("a"), F.col("b")).alias("cosine"), (-manhattan(F.col("a"), F.col("b"))).alias("manhattan"), (-euclidean(F.col("a"), F.col("b"))).alias("euclidean"), dot(F.col("a"), F.col("b")).alias("dot"))
    long = s.select("y", F.explode(F.create_map(*[v for m in ("cosine", "manhattan", "euclidean", "dot") for v in (F.lit(m), F.col(m))])).alias("measure", "s"))
    ranked = average_ranks(average_ranks(long, "y", "ry", "measure"), "s", "rs", "measure")
    return ranked.groupBy("measure").agg(F.corr("s", "y").alias("pearson"), F.corr("rs", "ry").alias("spearman"))


def retrieval_groups(df: DataFrame, order: str, label: str, partition: str | None = None) -> DataFrame:
    """Append `grp`: the number of positives so far. Rows before the first positive are left out."""
    w = (Window.partitionBy(partition) if partition else Window.partitionBy(F.lit(1))).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("grp", F.sum((F.col(label) == 1).cast("int")).over(w)).where("grp > 0")


def reranker_metrics(df: DataFrame, order: str, score: str, label: str, partition: str) -> DataFrame:
    """One row: MRR and NDCG over the groups of two rows at least."""
    g = retrieval_groups(df, order, label, partition)
    keys = [partition, "grp"]
    ranked = g.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), order)))
    gain = F.col(label) / F.log2(F.col("rank") + 1.0)
    per = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col(label) == 1, F.col("rank"))).alias("first"), F.sum(gain).alias("dcg"), F.sum((F.col(label) == 1).cast("int")).alias("pos")).where("n >= 2")
    ideal = F.aggregate(F.sequence(F.lit(1), F.col("pos").cast("int")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1.0))
    return per.agg(F.avg(F.coalesce(1 / F.col("first"), F.lit(0.0))).alias("mrr"), F.avg(F.when(F.col("pos") > 0, F.col("dcg") / ideal).otherwise(0.0)).alias("ndcg"))


def in_batch_margins(df: DataFrame, batch: str, row: str, anchor: str, positive: str) -> DataFrame:
    """One row: mean similarity with the own positive, with the other positives of the batch, and their margin.

    Sums of normalised vectors stand for the other pairs: the sum over all positives of a batch is one vector.
    """
    unit = lambda c: F.transform(c, lambda x: x / F.sqrt(dot(F.col(c), F.col(c))))
    x = df.select(batch, row, unit(anchor).alias("a"), unit(positive).alias("p"))
    sums = x.select(batch, F.posexplode("p").alias("i", "v")).groupBy(batch, "i").agg(F.sum("v").alias("v")).groupBy(batch).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("all"))
    n = x.groupBy(batch).agg(F.count(F.lit(1)).alias("n"))
    y = x.join(sums, batch).join(n, batch).where("n > 1")
    own = dot(F.col("a"), F.col("p"))
    others = (dot(F.col("a"), F.col("all")) - own) / (F.col("n") - 1)
    return y.select(own.alias("pos"), others.alias("neg")).agg(F.avg("pos").alias("mean_pos"), F.avg("neg").alias("mean_neg"), (F.avg("pos") - F.avg("neg")).alias("margin"))


def leaderboard(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias("value"), F.count(value).alias("n"))


def grouped_accuracy(df: DataFrame, hit: Column, parsed: Column, group: str) -> DataFrame:
    """Accuracy and parse rate of every group and (group null) of all; null groups count as 'unknown'."""
    x = df.select(F.coalesce(F.col(group).cast("string"), F.lit("unknown")).alias("grp"), hit.cast("double").alias("h"), parsed.cast("double").alias("p"))
    return x.rollup("grp").agg(F.avg("h").alias("accuracy"), F.avg("p").alias("parse_rate"), F.count(F.lit(1)).alias("n"))


def conditional_mean(value: Column, when: Column) -> Column:
    return F.coalesce(F.avg(F.when(when, value)), F.lit(0.0))


def grounding(df: DataFrame, iou: Column, threshold: float = 0.5) -> DataFrame:
    x = df.select(iou.alias("iou"))
    return x.agg(F.avg("iou").alias("mean_iou"), F.avg((F.col("iou") >= threshold).cast("double")).alias("acc"), F.count(F.lit(1)).alias("n"))


def multi_box_iou(pred: Column, gold: Column) -> Column:
    """array<double>: IoU of every gold box under the best assignment."""

    @F.pandas_udf("array<double>")
    def run(p: pd.Series, g: pd.Series) -> pd.Series:
        return pd.Series([matched_iou([list(x) for x in a] if a is not None else [], [list(x) for x in b] if b is not None else []) for a, b in zip(p, g, strict=True)], dtype=object)

    return run(pred, gold)


def quantile_threshold(df: DataFrame, value: str, q: float) -> DataFrame:
    """One row `t`: the q-quantile of the values that are there, between the two nearest ones; null without any.

    The two are found by their numbers in the order of values, which no task sorts as a whole.
    """
    from quarry.operators.preprocess import ordinal

    x = df.select(F.col(value).cast("double").alias("v")).where(F.col(value).isNotNull())
    at = max(x.count() - 1, 0) * q
    pair = ordinal(x, "v", name="i").where(F.col("i").isin(int(at), math.ceil(at)))
    return pair.agg((F.min("v") + (F.max("v") - F.min("v")) * (at - int(at))).alias("t"))


def sample_statistics(x: Column, w: Column) -> tuple[Column, Column]:
    """Geometric mean of x, and effective sample size of weights w."""
    return F.exp(F.avg(F.log(x))), F.sum(w) * F.sum(w) / F.sum(w * w)
