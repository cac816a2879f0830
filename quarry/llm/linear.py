"""Sparse linear classifiers on hashed n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.cluster import trim
from quarry.llm.textblocks import U64, blocks, lower, mix, slices, span_hashes, window_hashes

#: Labelled rows that a classifier is fitted on at most, half of each label (those of least hash).
SAMPLE_ROWS = 4096
_CLASS = np.full(256, 2, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58] = _CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1

#: Hash of a feature that stands for a property of the text rather than for one n-gram.
REPEATED = U64(0x5851F42D4C957F2D)
EMPTY = U64(0x14057B7EF767814F)


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first token number of each row: runs of letters and digits, and runs of other signs."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    kind = _CLASS[data]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    cut[1:n] |= kind[1:] != kind[:-1]
    cut[n] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    keep = kind[starts] != 0
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(starts, offs)


def ngram_features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, value) of each word and word pair, values sum to 1 for each length; and of the share of repeated 5-grams.

    Keys may repeat within a row; their values then add up. A row without any token has the single feature EMPTY.
    """
    starts, ends, first = tokens(data, offs)
    h = span_hashes(data, starts, ends)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    per = 1.0 / np.maximum(count, 1)
    pair = np.flatnonzero(row[1:] == row[:-1])
    keys = [h, mix(h[pair] * U64(0x9E3779B97F4A7C15) + h[pair + 1])]
    rows, values = [row, row[pair]], [per[row], per[row[pair]]]
    five = np.flatnonzero(row[4:] == row[:-4]) if len(row) > 4 else np.zeros(0, np.int64)
    if len(five):
        g = window_hashes(h, 5)[five] ^ mix(row[five].astype(U64))
        order = np.argsort(g, kind="stable")
        again = np.zeros(len(g), bool)
        again[order[1:]] = g[order[1:]] == g[order[:-1]]
        hit = row[five][again]
        keys.append(np.full(len(hit), REPEATED))
        rows.append(hit)
        values.append(4 * per[hit])
    none = np.flatnonzero(count == 0)
    keys.append(np.full(len(none), EMPTY))
    rows.append(none)
    values.append(np.ones(len(none)))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(values)


#: Bytes of the word beginnings that word_features() adds.
PREFIXES = (4, 5, 6, 7, 8)


def word_features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, 1) of each lower-cased word and of its first bytes, PREFIXES. Keys may repeat within a row.

    The last three bits of a key tell what it stands for: 0 a word, i a beginning of PREFIXES[i - 1] bytes.
    """
    data = lower(data)
    starts, ends, first = tokens(data, offs)
    letters = _CLASS[data[starts]] == 1 if len(starts) else np.zeros(0, bool)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[letters]
    starts, ends = starts[letters], ends[letters]
    keys, rows = [span_hashes(data, starts, ends) & ~U64(7)], [row]
    for i, n in enumerate(PREFIXES, 1):
        long = ends - starts > n
        keys.append(mix(span_hashes(data, starts[long], starts[long] + n) ^ U64(n)) & ~U64(7) | U64(i))
        rows.append(row[long])
    key = np.concatenate(keys)
    return np.concatenate(rows), key, np.ones(len(key))


Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Model:
    """Weights by 64-bit key (sorted, non-zero ones only). once: a key counts once for each text."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    once: bool = False

    def logits(self, row: np.ndarray, key: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        if not len(self.keys):
            return np.full(n, self.bias)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == key)
        r, a, v = row[hit], at[hit], value[hit]
        if self.once:
            both = np.unique(r.astype(np.int64) * len(self.keys) + a)
            r, a = both // len(self.keys), both % len(self.keys)
            v = np.ones(len(both))
        return self.bias + np.bincount(r, self.weights[a] * v, n)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, once: bool = False, epochs: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> Model:
    """Follow-the-regularised-leader-proximal over rows of (distinct keys, values) with labels from 0 to 1.

    Every coordinate keeps the sum of its adjusted gradients and of their squares; weights follow from them in
    closed form and are exactly 0 where the sum stays below l1.  Order and result depend on the input alone.
    """
    if not rows:
        return Model(np.zeros(0, U64), np.zeros(0), 0.0, once)
    keys, at = np.unique(np.concatenate([k for k, _ in rows]), return_inverse=True)
    cuts = np.cumsum([len(k) for k, _ in rows])[:-1]
    index = np.split(at, cuts)
    n = len(keys)
    z, s = np.zeros(n + 1), np.zeros(n + 1)
    order = np.random.default_rng(7).permutation(len(rows))
    for _ in range(epochs):
        for i in order:
            j = np.append(index[i], n)
            x = np.append(rows[i][1], 1.0)
            zj, root = z[j], np.sqrt(s[j])
            lam = np.where(j == n, 0.0, l1)
            w = np.where(np.abs(zj) > lam, -(zj - np.sign(zj) * lam) / ((beta + root) / alpha + l2), 0.0)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -40, 40)))
            g = (p - labels[i]) * x
            z[j] = zj + g - (np.sqrt(s[j] + g * g) - root) / alpha * w
            s[j] += g * g
    lam = np.append(np.full(n, l1), 0.0)
    w = np.where(np.abs(z) > lam, -(z - np.sign(z) * lam) / ((beta + np.sqrt(s)) / alpha + l2), 0.0)
    keep = np.flatnonzero(w[:-1])
    return Model(keys[keep], w[keep], float(w[-1]), once)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fold: int, folds: int, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label double, text) of at most `rows` labelled texts whose crc32(doc_id) mod folds is not `fold`.

    Of each label, 0 and 1, the rows of least hash of the doc_id are taken, at most half of `rows`; of several
    labels of one document the largest counts.
    """
    train = training_labels(labels, label, fold, folds)
    half = [train.where(F.col("label") == y).orderBy(F.xxhash64(F.lit(11), "__id"), "__id").limit(rows // 2) for y in (0.0, 1.0)]
    least = half[0].union(half[1])
    # One text for each id, so that repeated rows do not lift the bound.
    met = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(least, "__id")
    return met.groupBy("__id").agg(F.first("label").alias("label"), F.min("__text").alias("text")).withColumnRenamed("__id", "doc_id")


def training_labels(labels: DataFrame, label: str, fold: int, folds: int) -> DataFrame:
    """(__id, label double) of the documents labelled outside of the fold."""
    train = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", fold, folds))
    return train.groupBy(F.col("doc_id").alias("__id")).agg(F.max(F.col(label).cast("double")).alias("label"))


def class_share(labels: DataFrame, label: str, fold: int, folds: int) -> float:
    """Share of label 1 among all training labels, kept away from 0 and 1."""
    r = training_labels(labels, label, fold, folds).agg(F.sum("label").alias("n"), F.count(F.lit(1)).alias("all")).first()
    return (float(r["n"] or 0) + 1) / (r["all"] + 2)


def for_share(model: Model, target: np.ndarray, share: float) -> Model:
    """The model of a sample with other shares of the labels, moved to the given share of label 1."""
    if not len(target):
        return model
    own = (float(target.sum()) + 1) / (len(target) + 2)
    return Model(model.keys, model.weights, model.bias + float(np.log(share / (1 - share)) - np.log(own / (1 - own))), model.once)


def held_out(doc_id: str, fold: int, folds: int):
    """crc32 of the id as text modulo folds equals fold; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample_features(sample: DataFrame, features: Features, once: bool) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """ids, labels and (distinct keys, values) of the rows of a bounded sample, in order of id; features are made by the executors."""
    schema = "doc_id string, label double, keys binary, vals binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            ids, ys = batch.column(0).cast(pa.string()), batch.column(1)
            keys, vals = [], []
            for _, data, offs in blocks(batch.column(2)):
                row, key, value = features(data, offs)
                order = np.lexsort((key, row))
                row, key, value = row[order], key[order], value[order]
                cut = np.searchsorted(row, np.arange(len(offs)))
                for a, b in zip(cut[:-1], cut[1:], strict=True):
                    k, at = np.unique(key[a:b], return_index=True)
                    v = np.zeros(0) if once or not len(k) else np.add.reduceat(value[a:b], at)
                    keys.append(k.tobytes())
                    vals.append(v.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([ids, ys, pa.array(keys, pa.binary()), pa.array(vals, pa.binary())], names=["doc_id", "label", "keys", "vals"])
        trim()

    got = sample.select("doc_id", "label", "text").mapInArrow(run, schema).toArrow().sort_by("doc_id")
    keys = [np.frombuffer(k.as_buffer(), U64) for k in got["keys"]]
    vals = [np.broadcast_to(1.0, len(k)) for k in keys] if once else [np.frombuffer(v.as_buffer(), np.float32) for v in got["vals"]]
    return np.array(got["doc_id"].to_pylist(), object), np.array(got["label"].to_pylist(), float), list(zip(keys, vals, strict=True))


def score(docs: DataFrame, model: Model, features: Features, text: str = "text", name: str = "score") -> DataFrame:
    """Append `name`, the probability of label 1, to every row: a sparse dot product over the whole text."""
    cols = [c for c in docs.columns if c != name]
    out = docs.select(*cols, F.col(text).alias("__text"))
    schema = docs.select(*cols).schema.add(name, "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # non-zero weights of a bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, -1):
            got = [np.zeros(0)]
            for _, data, offs in blocks(batch.column(batch.num_columns - 1)):
                got.append(sigmoid(shared.value.logits(*features(data, offs), len(offs) - 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(got))], names=schema.names)
        trim()

    return out.mapInArrow(run, schema)


def scored(docs: DataFrame, model: Model, features: Features, text: str, fold: int, folds: int, threshold: float, names: tuple[str, str, str]) -> DataFrame:
    """Append to docs, under the given names, the score, whether it reaches the threshold (int), and whether the row is held out."""
    value, predicted, held = names
    return score(docs.drop(predicted, held), model, features, text, value).withColumns({predicted: (F.col(value) >= threshold).cast("int"), held: held_out("doc_id", fold, folds)})
