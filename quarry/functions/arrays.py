"""Numeric functions on array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once. A lambda evaluates what it captures for every element; its own argument it does not."""
    return F.element_at(F.transform(F.array(value), use), 1)


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def mean(x: Column) -> Column:
    return F.when(F.size(x) > 0, total(x) / F.size(x))


def masked_total(x: Column, mask: Column) -> Column:
    return total(F.zip_with(x, mask, lambda v, m: F.when(m != 0, v).otherwise(F.lit(0.0))))


def masked_mean(x: Column, mask: Column) -> Column:
    """Mean of the values whose mask is set; null without any."""
    n = F.aggregate(mask, F.lit(0), lambda a, m: a + F.when(m != 0, 1).otherwise(0))
    return F.when(n > 0, masked_total(x, mask) / n)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def manhattan(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))))


def log_sum_exp(x: Column) -> Column:
    top = F.array_max(x)
    return top + F.log(total(F.transform(x, lambda v: F.exp(v - top))))


def clamp(x: Column, low: float | Column, high: float | Column) -> Column:
    lift = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.least(F.greatest(x, lift(low)), lift(high))


def sorted_box(b: Column) -> Column:
    """(x1, y1, x2, y2) with x1 <= x2 and y1 <= y2."""
    g = lambda i: F.get(b, F.lit(i))
    return F.array(F.least(g(0), g(2)), F.least(g(1), g(3)), F.greatest(g(0), g(2)), F.greatest(g(1), g(3)))


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes with corners in any order; 0 where the union is empty."""
    a, b = sorted_box(a), sorted_box(b)
    g = lambda x, i: F.get(x, F.lit(i))
    side = lambda lo, hi: F.greatest(F.least(g(a, hi), g(b, hi)) - F.greatest(g(a, lo), g(b, lo)), F.lit(0.0))
    area = lambda x: (g(x, 2) - g(x, 0)) * (g(x, 3) - g(x, 1))
    both = side(0, 2) * side(1, 3)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def scaled_box(b: Column, width: Column, height: Column, kind: str = "real", target: str = "norm1000") -> Column:
    """Coordinates from pixels ('real') or [0, 1] ('norm1') to 0-1000 ('norm1000') or pixels, half to even."""
    def one(v: Column, i: Column) -> Column:
        size = F.when(i % 2 == 0, width).otherwise(height)
        unit = v / size if kind == "real" else v
        return F.bround(unit * (1000 if target == "norm1000" else size), 0).cast("int")

    return F.transform(b, one)


def unit_box(b: Column, scale: float = 1000.0) -> Column:
    """Clipped to [0, 1] after division by scale, corners sorted."""
    return sorted_box(F.transform(b, lambda v: clamp(v / scale, 0.0, 1.0)))


def ngrams(words: Column, n: int) -> Column:
    """Runs of n words joined by blanks; none where there are fewer."""
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - F.lit(n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
    return let(words, lambda w: F.when(F.size(w) >= n, runs(w)).otherwise(F.array().cast("array<string>")))


def sublist_positions(x: Column, part: Column) -> Column:
    """0-based positions at which `part` lies in x."""
    at = F.sequence(F.lit(0), F.size(x) - F.size(part))
    return F.when((F.size(part) > 0) & (F.size(x) >= F.size(part)), F.filter(at, lambda i: F.slice(x, i + 1, F.size(part)) == part)).otherwise(F.array().cast("array<int>"))


def position_ids(lengths: Column) -> Column:
    """0..l-1 for each length, one after the other."""
    return F.flatten(F.transform(F.filter(lengths, lambda n: n > 0), lambda n: F.sequence(F.lit(0), n - 1)))


def discounted_future(x: Column, gamma: float) -> Column:
    """At each place the sum of this and all later values, each discounted by gamma per step."""
    folded = F.aggregate(F.reverse(x), F.array().cast("array<double>"), lambda acc, v: F.concat(F.array(v + gamma * F.coalesce(F.get(acc, F.lit(0)), F.lit(0.0))), acc))
    return folded


def top_k(x: Column, k: int) -> Column:
    return F.slice(F.sort_array(x, asc=False), 1, k)


def pad(x: Column, length: Column | int, value, left: bool = False) -> Column:
    n = length if isinstance(length, Column) else F.lit(length)
    fill = F.array_repeat(F.lit(value), F.greatest(n - F.size(x), F.lit(0)).cast("int"))
    return F.concat(fill, x) if left else F.concat(x, fill)


def key_value_scores(pred: Column, gold: Column) -> Column:
    """struct(precision, recall, f1) of two maps by equal keys with equal values; empty sides give 0 (both empty: 1)."""
    hit = F.size(F.map_filter(pred, lambda k, v: F.try_element_at(gold, k) == v)).cast("double")
    p, r = hit / F.size(pred), hit / F.size(gold)
    both = (F.size(pred) == 0) & (F.size(gold) == 0)
    zero = F.when(both, 1.0).otherwise(0.0)
    ok = (F.size(pred) > 0) & (F.size(gold) > 0)
    return F.struct(F.when(ok, p).otherwise(zero).alias("precision"), F.when(ok, r).otherwise(zero).alias("recall"), F.when(ok & (hit > 0), 2 * p * r / (p + r)).otherwise(zero).alias("f1"))


def first_given(values: Column, empty: Column) -> Column:
    """The first value that is neither null nor `empty` (0, '' or false by its type); null without any."""
    return F.get(F.filter(values, lambda x: x.isNotNull() & (x != empty)), F.lit(0))


def _there(values: Column) -> Column:
    return F.filter(values, lambda x: x.isNotNull() & ~F.isnan(x))


def nan_total(values: Column) -> Column:
    """The sum of the doubles that are there; 0 without any. Null and NaN both count as missing."""
    return F.aggregate(_there(values), F.lit(0.0), lambda a, x: a + x)


def nan_mean(values: Column) -> Column:
    """The mean of the doubles that are there; NaN without any."""
    return let(_there(values), lambda v: F.when(F.size(v) > 0, F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)).otherwise(float("nan")))


def nan_std(values: Column) -> Column:
    """The sample deviation of the doubles that are there; NaN for fewer than two."""
    total_ = lambda v, f: F.aggregate(v, F.lit(0.0), lambda a, x: a + f(x))
    spread = lambda v: let(total_(v, lambda x: x) / F.size(v), lambda m: F.sqrt(total_(v, lambda x: (x - m) * (x - m)) / (F.size(v) - 1)))
    return let(_there(values), lambda v: F.when(F.size(v) > 1, spread(v)).otherwise(float("nan")))
