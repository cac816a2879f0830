"""Advantages, policy losses, preference losses and off-policy diagnostics over given log probabilities.

Group statistics are window aggregates; per-token maths are array functions.  A null reward counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.arrays import clamp, discounted_future, log_sum_exp, masked_mean, masked_total, total

STD_EPS = 1e-4


def weighted_reward(rewards: list[Column], weights: list[float]) -> Column:
    """Sum of weight * reward over the rewards that are there."""
    out = F.lit(0.0)
    for r, w in zip(rewards, weights, strict=True):
        out = out + F.coalesce(F.nanvl(r.cast("double"), F.lit(None).cast("double")), F.lit(0.0)) * w
    return out


def kl_reward(reward: Column, kl: Column, beta: float) -> Column:
    return reward - beta * kl


def advantages(df: DataFrame, group: str, reward: str, estimator: str = "grpo", scale: str = "group", name: str = "advantage") -> DataFrame:
    """Group-relative advantages.

    grpo: reward - group mean. rloo: against the mean of the other rows. reinforce_plus_plus: as grpo, scaled by the
    deviation of the advantages. scale: 'group', 'batch' or 'none'; groups of one row have deviation 0.
    """
    w = Window.partitionBy(group)
    r, n, m = F.col(reward), F.count(reward).over(w), F.avg(reward).over(w)
    if estimator == "rloo":
        adv = F.when(n > 1, r * n / (n - 1) - m * n / (n - 1)).otherwise(F.lit(0.0))
    elif estimator in ("grpo", "reinforce_plus_plus"):
        adv = r - m
    else:
        raise ValueError(estimator)
    out = df.withColumn("__a", adv)
    if scale == "none":
        return out.withColumnRenamed("__a", name)
    value = "__a" if estimator == "reinforce_plus_plus" else reward
    if scale == "group":
        sd = F.coalesce(F.stddev_samp(value).over(w), F.lit(0.0))
        return out.withColumn(name, F.col("__a") / (sd + STD_EPS)).drop("__a")
    if scale == "batch":
        one = out.agg(F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("__sd"))
        return out.join(F.broadcast(one)).withColumn(name, F.col("__a") / (F.col("__sd") + STD_EPS)).drop("__a", "__sd")
    raise ValueError(scale)


def per_function_advantages(df: DataFrame, group: str, rewards: dict[str, float], name: str = "advantage") -> DataFrame:
    """Each reward is standardised in its group (missing: 0), summed by weight, then standardised over all rows."""
    w = Window.partitionBy(group)
    total_ = F.lit(0.0)
    for c, weight in rewards.items():
        z = (F.col(c) - F.avg(c).over(w)) / (F.coalesce(F.stddev_samp(c).over(w), F.lit(0.0)) + 1e-8)
        total_ = total_ + weight * F.coalesce(z, F.lit(0.0))
    out = df.withColumn("__a", total_)
    one = out.agg(F.avg("__a").alias("__m"), F.coalesce(F.stddev_samp("__a"), F.lit(0.0)).alias("__sd"))
    return out.join(F.broadcast(one)).withColumn(name, (F.col("__a") - F.col("__m")) / (F.col("__sd") + 1e-8)).drop("__a", "__m", "__sd")


def request_advantages(df: DataFrame, group: str, request: str, order: str, reward: str, name: str = "advantage") -> DataFrame:
    """Advantages over distinct requests, the last row of each by order; every row gets its request's value."""
    w = Window.partitionBy(request).orderBy(F.desc(order))
    last = df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
    found = advantages(last, group, reward, name=name).select(request, name)
    return df.join(found, request)


def reward_metrics(df: DataFrame, group: str, reward: str) -> DataFrame:
    """One row: mean of group means, mean of group deviations, batch deviation and the share of groups without any."""
    g = df.groupBy(group).agg(F.avg(reward).alias("m"), F.coalesce(F.stddev_samp(reward), F.lit(0.0)).alias("sd"))
    one = g.agg(F.avg("m").alias("reward"), F.avg("sd").alias("group_std"), F.avg((F.col("sd") <= 1e-8).cast("double")).alias("frac_zero_std"))
    return one.join(F.broadcast(df.agg(F.coalesce(F.stddev_samp(reward), F.lit(0.0)).alias("batch_std"))))


def kept_mask(mask: Column, finish_reason: Column) -> Column:
    """The completion mask, all 0 where the completion was cut for its length."""
    return F.when(F.coalesce(finish_reason == "length", F.lit(False)), F.transform(mask, lambda _: F.lit(0))).otherwise(mask)


# Per-token maths.


def k3(teacher: Column, student: Column, mask: Column) -> Column:
    """e^d - d - 1 with d = teacher - student where the mask is set, else 0."""
    d = F.zip_with(F.zip_with(teacher, student, lambda t, s: t - s), mask, lambda d, m: F.when(m != 0, d).otherwise(F.lit(0.0)))
    return F.transform(d, lambda x: F.exp(x) - x - 1)


def k1(teacher: Column, student: Column, mask: Column) -> Column:
    return F.zip_with(F.zip_with(teacher, student, lambda t, s: t - s), mask, lambda d, m: F.when(m != 0, d).otherwise(F.lit(0.0)))


def token_advantage(adv: Column, teacher: Column, student: Column, coef: float) -> Column:
    return F.zip_with(teacher, student, lambda t, s: adv + coef * (t - s))


def reweighted(adv: Column, delta: Column, lam: float, eps: float, negative_only: bool = False) -> Column:
    """adv * ((1 - lam) + lam * clip(e^(sign(adv) * delta), 1 +- eps)) per token; with negative_only other rows keep adv."""
    w = F.transform(delta, lambda d: (1 - lam) + lam * clamp(F.exp(F.signum(adv) * d), 1 - eps, 1 + eps))
    out = F.transform(w, lambda x: x * adv)
    return F.when(adv < 0, out).otherwise(F.transform(delta, lambda _: adv)) if negative_only else out


def gated(loss: Column, delta: Column, beta: float) -> Column:
    """Loss per token times sigmoid(beta * delta)."""
    return F.zip_with(loss, delta, lambda x, d: x / (1 + F.exp(-beta * d)))


def aggregate_loss(df: DataFrame, loss: str, mask: str, mode: str) -> DataFrame:
    """One row `loss`: token-mean, seq-mean-token-sum or seq-mean-token-mean."""
    s = masked_total(F.col(loss), F.col(mask))
    n = F.aggregate(mask, F.lit(0), lambda a, m: a + F.when(m != 0, 1).otherwise(0))
    if mode == "token-mean":
        return df.agg((F.sum(s) / F.greatest(F.sum(n), F.lit(1))).alias("loss"))
    if mode == "seq-mean-token-sum":
        return df.agg(F.avg(s).alias("loss"))
    if mode == "seq-mean-token-mean":
        return df.agg(F.avg(s / F.greatest(n, F.lit(1))).alias("loss"))
    raise ValueError(mode)


def log_ratios(new: Column, old: Column, limit: float = 20.0) -> Column:
    return F.zip_with(new, old, lambda a, b: clamp(a - b, -limit, limit))


def importance(new: Column, old: Column, mask: Column, level: str = "token") -> Column:
    """Ratios per token: of each token, or of the sequence (geometric mean) at every token."""
    d = log_ratios(new, old)
    if level == "token":
        return F.transform(d, lambda x: F.exp(x))
    if level == "sequence":
        m = F.exp(F.coalesce(masked_mean(d, mask), F.lit(0.0)))
        return F.transform(d, lambda _: m)
    raise ValueError(level)


def policy_loss(ratio: Column, adv: Column, logp: Column, kind: str = "grpo", low: float = 0.2, high: float = 0.2, cap: float | None = None, tau: tuple[float, float] = (1.0, 1.05)) -> Column:
    """Loss per token of the clipped objective and its variants."""
    if kind in ("grpo", "bnpo", "dr_grpo", "dapo", "fipo"):
        capped = (lambda r: F.least(r, F.lit(cap))) if cap is not None else (lambda r: r)
        return F.transform(ratio, lambda r: -F.least(capped(r) * adv, clamp(r, 1 - low, 1 + high) * adv))
    if kind == "cispo":
        return F.zip_with(ratio, logp, lambda r, p: -F.least(r, F.lit(high)) * adv * p)
    if kind == "sapo":
        t = F.when(adv > 0, F.lit(tau[0])).otherwise(F.lit(tau[1]))
        return F.transform(ratio, lambda r: -(4 / t) / (1 + F.exp(-t * (r - 1))) * adv)
    raise ValueError(kind)


def reduced_loss(df: DataFrame, loss: str, mask: str, kind: str, max_length: int | None = None, items: int | None = None) -> DataFrame:
    """One row `loss`, reduced the way of its kind."""
    s = masked_total(F.col(loss), F.col(mask))
    n = F.aggregate(mask, F.lit(0), lambda a, m: a + F.when(m != 0, 1).otherwise(0))
    if kind in ("grpo", "sapo"):
        return df.agg(F.avg(s / F.greatest(n, F.lit(1))).alias("loss"))
    if kind == "bnpo":
        return df.agg((F.sum(s) / F.greatest(F.sum(n), F.lit(1))).alias("loss"))
    if kind == "dr_grpo":
        return df.agg((F.sum(s) / (F.count(F.lit(1)) * max_length)).alias("loss"))
    if kind in ("dapo", "cispo", "fipo"):
        return df.agg((F.sum(s) / F.greatest(F.lit(items) if items else F.sum(n), F.lit(1))).alias("loss"))
    raise ValueError(kind)


def contrast_loss(df: DataFrame, group: str, score: str, adv: str, tau: float = 1.0) -> DataFrame:
    """(group, loss): log(1 + sum e^(-s/tau) of rows with positive advantage) and log(1 + sum e^(s/tau) of the others), groups with both signs."""
    s = F.col(score) / tau
    pos, neg = F.collect_list(F.when(F.col(adv) > 0, -s)), F.collect_list(F.when(F.col(adv) < 0, s))
    g = df.groupBy(group).agg(pos.alias("p"), neg.alias("n")).where((F.size("p") > 0) & (F.size("n") > 0))
    zero = F.array(F.lit(0.0))
    return g.select(group, (log_sum_exp(F.concat(zero, "p")) + log_sum_exp(F.concat(zero, "n"))).alias("loss"))


def future_weights(kl: Column, gamma: float) -> Column:
    """Discounted sum of a token's own and later divergences."""
    return discounted_future(kl, gamma)


def rollout_weights(new: Column, rollout: Column, mask: Column, mode: str, threshold: float = 2.0) -> Column:
    """Importance weights of sampled tokens: cut or masked above the threshold, per token or per sequence."""
    d = log_ratios(new, rollout)
    token = F.transform(d, lambda x: F.exp(x))
    sequence = F.exp(F.coalesce(masked_mean(d, mask), F.lit(0.0)))
    if mode == "token_truncate":
        return F.transform(token, lambda r: F.least(r, F.lit(threshold)))
    if mode == "token_mask":
        return F.transform(token, lambda r: F.when(r <= threshold, r).otherwise(F.lit(0.0)))
    if mode == "sequence_truncate":
        return F.transform(token, lambda _: F.least(sequence, F.lit(threshold)))
    if mode == "sequence_mask":
        return F.transform(token, lambda _: F.when(sequence <= threshold, sequence).otherwise(F.lit(0.0)))
    raise ValueError(mode)


def off_policy_kept(old: Column, new: Column, mask: Column, adv: Column, delta: float) -> Column:
    """False for sequences with negative advantage whose mean log(old / new) is above delta."""
    return ~((F.coalesce(masked_mean(F.zip_with(old, new, lambda a, b: a - b), mask), F.lit(0.0)) > delta) & (adv < 0))


def off_policy_metrics(df: DataFrame, new: str, rollout: str, mask: str) -> DataFrame:
    """One row of divergence measures between training and sampling log probabilities."""
    a, b, m = F.col(new), F.col(rollout), F.col(mask)
    d = log_ratios(a, b)
    n = F.aggregate(m, F.lit(0), lambda acc, x: acc + F.when(x != 0, 1).otherwise(0))
    x = df.select(
        n.alias("n"),
        masked_total(F.transform(d, lambda v: -v), m).alias("kl"),
        masked_total(F.transform(d, lambda v: F.exp(v) - v - 1), m).alias("k3"),
        masked_mean(a, m).alias("la"),
        masked_mean(b, m).alias("lb"),
        masked_total(F.transform(d, lambda v: F.exp(2 * v)), m).alias("sq"),
        F.coalesce(masked_total(d, m), F.lit(0.0)).alias("seq"),
    ).where("n > 0")
    diff = F.col("lb") - F.col("la")
    return x.agg(
        (F.sum("kl") / F.sum("n")).alias("kl"), (F.sum("k3") / F.sum("n")).alias("k3_kl"),
        F.avg(F.exp(-F.col("la"))).alias("training_ppl"), F.avg(F.exp(-F.col("lb"))).alias("rollout_ppl"),
        F.avg(diff).alias("log_ppl_diff"), F.avg(F.abs(diff)).alias("log_ppl_abs_diff"), F.max(diff).alias("log_ppl_diff_max"), F.min(diff).alias("log_ppl_diff_min"),
        F.avg(F.exp(diff)).alias("ppl_ratio"), (F.sum("sq") / F.sum("n") - 1).alias("chi2_token"), (F.avg(F.exp(clamp(2 * F.col("seq"), -20.0, 20.0))) - 1).alias("chi2_seq"),
    )


def weight_metrics(df: DataFrame, weights: str, mask: str, threshold: float) -> DataFrame:
    """One row: mean weight, effective sample size (share of the number) and share of weights above the threshold."""
    w = df.select(F.explode(F.arrays_zip(F.col(weights).alias("w"), F.col(mask).alias("m"))).alias("x")).where("x.m <> 0").select(F.col("x.w").alias("w"))
    return w.agg(F.avg("w").alias("weight_mean"), (F.sum("w") * F.sum("w") / F.sum(F.col("w") * F.col("w")) / F.count("w")).alias("ess"), F.avg((F.col("w") > threshold).cast("double")).alias("clipped_frac"))


# Preference losses.


def log_sigmoid(x: Column) -> Column:
    return -F.log1p(F.exp(-F.abs(x))) + F.least(x, F.lit(0.0))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def preference_loss(c: Column, r: Column, kind: str = "sigmoid", beta: float = 0.1, eps: float = 0.0, delta: Column | float = 0.0, tau: float = 0.05, nll: Column | None = None) -> Column:
    """Loss of one pair; c and r are log ratios of policy to reference for the chosen and the rejected text."""
    z = c - r
    bz = beta * z
    if kind == "sigmoid":
        return -log_sigmoid(bz) * (1 - eps) - log_sigmoid(-bz) * eps
    if kind == "robust":
        return (-log_sigmoid(bz) * (1 - eps) + log_sigmoid(-bz) * eps) / (1 - 2 * eps)
    if kind == "exo_pair":
        import math

        e = eps or 1e-3
        return sigmoid(bz) * (log_sigmoid(bz) - math.log(1 - e)) + sigmoid(-bz) * (log_sigmoid(-bz) - math.log(e))
    if kind == "hinge":
        return F.greatest(F.lit(0.0), 1 - bz)
    if kind == "ipo":
        return F.pow(z - 1 / (2 * beta), 2)
    if kind == "bco_pair":
        d = delta if isinstance(delta, Column) else F.lit(delta)
        return -log_sigmoid(beta * c - d) - log_sigmoid(-(beta * r - d))
    if kind == "sppo_hard":
        return F.pow(c - 0.5 / beta, 2) + F.pow(r + 0.5 / beta, 2)
    if kind == "nca_pair":
        return -log_sigmoid(beta * c) - 0.5 * log_sigmoid(-beta * c) - 0.5 * log_sigmoid(-beta * r)
    if kind == "apo_zero":
        return 1 - sigmoid(beta * c) + sigmoid(beta * r)
    if kind == "apo_down":
        return sigmoid(beta * c) + 1 - sigmoid(bz)
    if kind == "discopop":
        m = sigmoid(bz / tau)
        return -log_sigmoid(bz) * (1 - m) + F.exp(-bz) * m
    if kind == "sft" and nll is not None:
        return nll
    raise ValueError(kind)


def divergence_margin(c: Column, r: Column, kind: str = "reverse_kl", alpha: float = 1.0) -> Column:
    """The margin z under another f-divergence: alpha or Jensen-Shannon instead of reverse KL."""
    if kind == "reverse_kl":
        return c - r
    if kind == "alpha_divergence":
        return (F.exp(-alpha * r) - F.exp(-alpha * c)) / alpha
    if kind == "js_divergence":
        return (c - r) - (F.log1p(F.exp(c)) - F.log1p(F.exp(r)))
    raise ValueError(kind)


def ranked_pairs(df: DataFrame, batch: str, row: str, c: str, r: str, beta: float = 0.1) -> DataFrame:
    """(batch, rank, loss): both sides sorted within the batch and paired by rank.

    c and r are log ratios of the chosen and the rejected (unpaired), or margins of policy and reference.
    """
    side = lambda x, n: df.select(batch, F.col(x).alias(n), F.row_number().over(Window.partitionBy(batch).orderBy(x, row)).alias("rank"))
    met = side(c, "__c").join(side(r, "__r"), [batch, "rank"])
    return met.select(batch, "rank", preference_loss(F.col("__c"), F.col("__r"), beta=beta).alias("loss"))


def kto_loss(policy: Column, reference: Column, label: Column, kl: Column, beta: float = 0.1, desirable: float = 1.0, undesirable: float = 1.0) -> Column:
    v = policy - reference
    return F.when(label, desirable * (1 - sigmoid(beta * (v - kl)))).otherwise(undesirable * (1 - sigmoid(beta * (kl - v))))


def simpo_loss(c: Column, r: Column, beta: float = 2.0, gamma: float = 1.0) -> Column:
    """c and r are mean log probabilities."""
    return -log_sigmoid(beta * (c - r) - gamma)


def cpo_loss(c: Column, r: Column, nll: Column, beta: float = 0.1, alpha: float = 1.0) -> Column:
    return -log_sigmoid(beta * (c - r)) + alpha * nll


def orpo_loss(c: Column, r: Column, nll: Column, beta: float = 0.1) -> Column:
    """nll plus the log odds ratio; c and r are mean log probabilities below 0."""
    odds = (c - r) - (F.log1p(-F.exp(c)) - F.log1p(-F.exp(r)))
    return nll - beta * log_sigmoid(odds)


def reward_model_loss(c: Column, r: Column, margin: Column | None = None, center: float = 0.0) -> Column:
    d = c - r if margin is None else c - r - F.coalesce(margin, F.lit(0.0))
    return -log_sigmoid(d) + center * F.pow(c + r, 2)


def jsd(student: Column, teacher: Column, beta: float = 0.5) -> Column:
    """Generalised Jensen-Shannon divergence of two arrays of log probabilities; 0 and 1 are the two KL divergences."""
    kl = lambda p, q: total(F.zip_with(p, q, lambda a, b: F.exp(a) * (a - b)))
    if beta == 0:
        return kl(teacher, student)
    if beta == 1:
        return kl(student, teacher)
    m = F.zip_with(student, teacher, lambda s, t: F.log((1 - beta) * F.exp(s) + beta * F.exp(t)))
    return beta * kl(teacher, m) + (1 - beta) * kl(student, m)


def renormalised_top(logp: Column, k: int) -> Column:
    """The k greatest log probabilities, renormalised."""
    top = F.slice(F.sort_array(logp, asc=False), 1, k)
    z = log_sum_exp(top)
    return F.transform(top, lambda x: x - z)


# Embedding and reranker losses.


def contrastive_loss(distance: Column, label: Column, margin: float = 0.5) -> Column:
    return 0.5 * (label * F.pow(distance, 2) + (1 - label) * F.pow(F.greatest(F.lit(margin) - distance, F.lit(0.0)), 2))


def online_contrastive_loss(df: DataFrame, batch: str, distance: str, label: str, margin: float = 0.5) -> DataFrame:
    """(batch, loss): only negatives nearer than the farthest positive, and positives farther than the nearest negative."""
    d, pos = F.col(distance), F.col(label) == 1
    w = Window.partitionBy(batch)
    x = df.withColumns({"__p": F.max(F.when(pos, d)).over(w), "__n": F.min(F.when(~pos, d)).over(w), "__all": F.avg(d).over(w)})
    hard_pos = F.when(pos & (d > F.coalesce("__n", "__all")), F.pow(d, 2))
    hard_neg = F.when(~pos & (d < F.coalesce("__p", "__all")), F.pow(F.greatest(F.lit(margin) - d, F.lit(0.0)), 2))
    return x.groupBy(batch).agg((F.coalesce(F.sum(hard_pos), F.lit(0.0)) + F.coalesce(F.sum(hard_neg), F.lit(0.0))).alias("loss"))


def infonce(similarities: Column, temperature: float = 0.01) -> Column:
    """Cross entropy of the first similarity, the positive's, against all."""
    x = F.transform(similarities, lambda s: s / temperature)
    return log_sum_exp(x) - F.get(x, F.lit(0))


def pointwise_loss(logit: Column, label: Column) -> Column:
    return F.greatest(logit, F.lit(0.0)) - logit * label + F.log1p(F.exp(-F.abs(logit)))


def listwise_loss(df: DataFrame, order: str, score: str, label: str, temperature: float = 1.0, partition: str | None = None) -> DataFrame:
    """(grp, loss): cross entropy of the positive in each group of two rows at least; a positive begins a group."""
    part = Window.partitionBy(partition) if partition else Window.partitionBy(F.lit(1))
    x = df.withColumn("grp", F.sum((F.col(label) == 1).cast("int")).over(part.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))).where("grp > 0")
    keys = [partition, "grp"] if partition else ["grp"]
    g = x.groupBy(*keys).agg(F.collect_list(F.col(score) / temperature).alias("s"), F.max(F.when(F.col(label) == 1, F.col(score) / temperature)).alias("p")).where(F.size("s") >= 2)
    return g.select(*keys, (log_sum_exp(F.col("s")) - F.col("p")).alias("loss"))


