"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on posterior labels.

1. Voters.  A public list of insults and a few patterns vote without any label.  Three further lexicons of different
   make are mined: whole words, short and long word beginnings.  Their candidates come from a bounded sample of
   labelled training rows, and those stay that are far more frequent in toxic than in clean texts over all training
   rows.  One more voter asks for several different words of the word lists.  The label of a training row is a voter
   too, which may err.
2. Label model.  The votes of *all* texts are counted by pattern (at most 3 * 2**voters rows).  Expectation
   maximisation fits the class prior and, for either class, a log-linear model of the votes with one weight for each
   voter and one for each pair whose votes are correlated within a class.  With few voters all 2**voters states are
   summed, so likelihoods, accuracies and correlations are exact.  The label voter has two rates of its own.
3. Classifier.  Posterior labels of a bounded sample of *all* texts, labelled or not, train a sparse logistic
   regression (FTRL) on words and word beginnings, each counted once a text; every whole text is scored by it.  Of
   all words and beginnings those are features that the posteriors, not the lexicons, show to be telling.

A null or empty text has no votes and gets the score of the bias; repeated rows get equal scores, ties are broken by
hashes and ids; without any labels only the public voters speak.  An empty table stays empty.  Very long texts form
a block of their own.  Columns of docs that are named like those appended give way to them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from quarry.llm.cluster import checkpointed, trim
from quarry.llm.linear import SAMPLE_ROWS, Model, for_share, labelled_sample, sample_features, scored, train_ftrl, training_labels, word_features
from quarry.llm.textblocks import U64, blocks, slices, span_hashes

FOLD, FOLDS = 2, 4
THRESHOLD = 0.3
#: How much more frequent in toxic texts a mined key is (log odds) and in how many of them it occurs.
MINED_LOG_ODDS = 3.0
MINED_TEXTS = 3
#: Common insults.
INSULTS = "idiot moron stupid loser scum trash worthless pathetic disgusting clown imbecile jerk filth vermin coward dumb bastard crap garbage retard".split()
#: Patterns that vote on the raw text (Java syntax).
PATTERNS = {
    "masked_word": r"\b\p{L}{1,2}[*#@$]{2,}\p{L}{0,4}\b",
    "second_person": r"(?i)\b(?:you|your|you're)\s+(?:are\s+)?(?:an?\s+)?(?:idiot|moron|loser|clown|scum|trash|stupid)",
    "shouted": r"\b\p{Lu}{4,}!{2,}",
}
#: Voters by their bit: lexicons, then `several`, then the patterns.
LEXICONS = ("insults", "words", "short_beginnings", "long_beginnings")
VOTERS = (*LEXICONS, "several", *PATTERNS)
#: Different words of the first two lexicons that `several` asks for.
SEVERAL = 2
#: Features of the classifier: texts of the sample that hold one at least, and its least log odds by the posteriors.
FEATURE_TEXTS = 4
FEATURE_LOG_ODDS = 1.0
_ROUNDS = 60
_PAIRS_FROM = 8
_CORRELATED = 0.05


def _states(m: int) -> np.ndarray:
    return (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)


def _terms(votes: np.ndarray, pairs: list[tuple[int, int]]) -> np.ndarray:
    """Votes, and products of the votes of pairs."""
    return np.column_stack([votes, *[votes[:, i] * votes[:, j] for i, j in pairs]])


@dataclass(frozen=True)
class LabelModel:
    """prior of class 1; weights (2, voters + pairs) of the log-linear model of either class; says: P(label 1 | class)."""

    prior: float
    weights: np.ndarray
    pairs: list[tuple[int, int]]
    says: np.ndarray

    @property
    def voters(self) -> int:
        return self.weights.shape[1] - len(self.pairs)

    def given(self) -> np.ndarray:
        """(2, 2**voters): probability of every state of the votes in either class."""
        e = self.weights @ _terms(_states(self.voters), self.pairs).T
        p = np.exp(e - e.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def fires(self) -> np.ndarray:
        """(voters, 2): how often each voter votes in either class."""
        return _states(self.voters).T @ self.given().T

    def correlations(self) -> np.ndarray:
        """(2, voters, voters): correlations of the votes within either class."""
        s, out = _states(self.voters), []
        for p in self.given():
            mean = p @ s
            cov = (s * p[:, None]).T @ s - np.outer(mean, mean)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            out.append(cov / np.outer(sd, sd))
        return np.array(out)

    def posterior(self, packed: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Probability of class 1 for votes packed in bits and labels 0 or 1 (nan: none)."""
        e = np.log(np.maximum(self.given()[:, packed], 1e-300)) + np.log([[1 - self.prior], [self.prior]])
        said = np.where(label == 1, np.log(self.says)[:, None], np.log1p(-self.says)[:, None])
        e = e + np.where(np.isnan(label), 0.0, said)
        return 1 / (1 + np.exp(np.clip(e[0] - e[1], -40, 40)))


def _fit_weights(w: np.ndarray, terms: np.ndarray, mean: np.ndarray, n: float, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Weights of the log-linear model whose means of the terms are those observed over n texts: damped Newton steps."""

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        e = terms @ w
        top = e.max()
        p = np.exp(e - top)
        return n * (mean @ w - top - np.log(p.sum())) - ridge / 2 * (w @ w), p / p.sum()

    now, p = value(w)
    for _ in range(steps):
        expected = p @ terms
        slope = n * (mean - expected) - ridge * w
        curve = n * ((terms * p[:, None]).T @ terms - np.outer(expected, expected)) + ridge * np.eye(len(w))
        step, scale = np.linalg.solve(curve, slope), 1.0
        while scale > 1e-4:
            then, q = value(w + scale * step)
            if then >= now:
                break
            scale /= 2
        else:
            break
        w, p, gain, now = w + scale * step, q, then - now, then
        if gain < 1e-9 * max(1.0, abs(now)):
            break
    return w


def fit_label_model(packed: np.ndarray, label: np.ndarray, counts: np.ndarray, voters: int) -> LabelModel:
    """EM over the counts of vote patterns, packed in bits, with labels 0 or 1 (nan: none).

    The first guess follows the label, or else whether any voter speaks; it fixes which class is which.  Pairs join
    the model once the votes alone have settled.
    """
    says, pairs = np.array([0.02, 0.95]), []
    weights = np.tile(np.array([[-3.0], [-1.0]]), (1, voters))
    if not len(counts) or counts.sum() == 0:
        return LabelModel(0.1, weights, pairs, says)
    votes, states = _states(voters)[packed], _states(voters)
    has, weight = ~np.isnan(label), counts.astype(float)
    post = np.where(has, np.where(label == 1, 0.95, 0.05), np.where(packed > 0, 0.7, 0.05))
    for turn in range(_ROUNDS):
        prior = float(np.clip((weight * post).sum() / weight.sum(), 1e-4, 0.5))
        if turn == _PAIRS_FROM:
            pairs = _correlated(votes, weight, post)
            weights = np.column_stack([weights, np.zeros((2, len(pairs)))])
        seen, terms = _terms(votes, pairs), _terms(states, pairs)
        share = (weight * (1 - post), weight * post)
        weights = np.array([_fit_weights(weights[c], terms, (m @ seen) / max(m.sum(), 1e-9), m.sum()) for c, m in enumerate(share)])
        yes, all_ = np.array([m[has & (label == 1)].sum() for m in share]), np.array([m[has].sum() for m in share])
        says = ((yes + np.array([0.2, 9.5])) / (all_ + 10)).clip([1e-3, 0.7], [0.2, 1 - 1e-3])
        model = LabelModel(prior, weights, pairs, says)
        post = model.posterior(packed, label)
    return model


def _correlated(votes: np.ndarray, weight: np.ndarray, post: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of voters whose votes are correlated within a class."""
    strong = np.zeros((votes.shape[1], votes.shape[1]))
    for p in (1 - post, post):
        m = weight * p
        n = max(m.sum(), 1e-9)
        mean = (m @ votes) / n
        cov = (votes * m[:, None]).T @ votes / n - np.outer(mean, mean)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        strong = np.maximum(strong, np.abs(cov / np.outer(sd, sd)))
    return [(i, j) for i in range(len(strong)) for j in range(i + 1, len(strong)) if strong[i, j] > _CORRELATED]


def key_sums(sample: DataFrame) -> DataFrame:
    """(key, toxic, n): of each word and beginning the texts of a sample (doc_id, label, text) that hold it, and their labels' sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            label, got = np.asarray(batch.column(0)), [(np.zeros(0, U64), np.zeros(0))]
            for first, data, offs in blocks(batch.column(1)):
                row, key, _ = word_features(data, offs)
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
                got.append((key[new], label[first + row[new]]))
            key, y = (np.concatenate(x) for x in zip(*got, strict=True))
            keys, at, n = np.unique(key, return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.bincount(at, y, len(keys))), pa.array(n)], names=["key", "toxic", "n"])
        trim()

    return sample.select("label", "text").mapInArrow(run, "key long, toxic double, n long").groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))


def _keys(found: DataFrame) -> np.ndarray:
    return np.sort(np.array([r["key"] for r in found.select("key").collect()], np.int64).view(U64))


def _sizes(sample: DataFrame) -> tuple[float, float]:
    r = sample.agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    return float(r["toxic"] or 0), float(r["n"] - (r["toxic"] or 0))


def lexicon_candidates(sample: DataFrame) -> np.ndarray:
    """Keys that at least MINED_TEXTS toxic texts of the sample hold and that are more frequent there than in its clean texts."""
    n1, n0 = _sizes(sample)
    if not n1 or not n0:
        return np.zeros(0, U64)
    return _keys(key_sums(sample).where((F.col("toxic") >= MINED_TEXTS) & (F.col("toxic") / n1 > 4 * (F.col("n") - F.col("toxic")) / n0)))


def key_hits(docs: DataFrame, keys: np.ndarray, text: str = "text") -> DataFrame:
    """(doc_id, hits array<int>, bits int): which of the sorted keys each whole text holds, and a bit for each pattern that it matches."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)  # from a bounded sample
    body = F.coalesce(F.col(text), F.lit(""))
    bits = sum((F.when(body.rlike(p), 1 << i).otherwise(0) for i, p in enumerate(PATTERNS.values())), F.lit(0))
    schema = docs.select("doc_id").schema.add("hits", ArrayType(IntegerType())).add("bits", IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        wide = len(keys) + 1
        for batch in slices(batches, 1):
            parts, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, data, offs in blocks(batch.column(1)):
                row, key, _ = word_features(data, offs)
                at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
                ok = keys[at] == key if len(keys) else np.zeros(len(key), bool)
                both = np.unique(row[ok].astype(np.int64) * wide + at[ok])
                parts.append(both % wide)
                sizes.append(np.bincount(both // wide, minlength=len(offs) - 1))
            ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
            hits = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), hits, batch.column(2)], names=schema.names)
        trim()

    return docs.select("doc_id", F.col(text).alias("__text"), bits.cast("int").alias("bits")).mapInArrow(run, schema)


def mined_keys(hits: DataFrame, train: DataFrame, candidates: int) -> np.ndarray:
    """Numbers of the candidates whose log odds reach MINED_LOG_ODDS over all texts with a training label, train (doc_id, __y)."""
    counts = np.zeros((2, candidates))
    found = hits.where(F.size("hits") > 0).join(train, "doc_id").select(F.explode("hits").alias("i"), (F.col("__y") > 0.5).cast("int").alias("y"))
    for r in found.groupBy("i", "y").count().collect():
        counts[r["y"], r["i"]] = r["count"]
    size = {r["y"]: r["count"] for r in train.groupBy((F.col("__y") > 0.5).cast("int").alias("y")).count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    odds = np.log((counts[1] + 0.1) / np.maximum(n1 - counts[1] + 0.1, 0.1)) - np.log((counts[0] + 0.1) / np.maximum(n0 - counts[0] + 0.1, 0.1))
    return np.flatnonzero((counts[1] >= MINED_TEXTS) & (odds >= MINED_LOG_ODDS) & (counts[1] > counts[0]))


def votes_of(hits: DataFrame, lexicon: np.ndarray) -> DataFrame:
    """(doc_id, votes int): a bit for each of VOTERS. lexicon[i]: number in LEXICONS of key i, or -1."""
    shared = hits.sparkSession.sparkContext.broadcast(lexicon)
    schema = hits.select("doc_id").schema.add("votes", IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = np.append(shared.value, -1)  # no hit is like one of no lexicon
        for batch in batches:
            column = batch.column(1)
            size = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
            row, kind = np.repeat(np.arange(len(size)), size), lexicon[np.asarray(column.flatten())]
            votes = np.zeros(len(size), np.int64)
            for i in range(len(LEXICONS)):
                votes[row[kind == i]] |= 1 << i
            words = np.bincount(row[(kind == 0) | (kind == 1)], minlength=len(size))
            votes |= (words >= SEVERAL).astype(np.int64) << len(LEXICONS)
            votes |= np.asarray(batch.column(2)).astype(np.int64) << len(LEXICONS) + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes.astype(np.int32))], names=schema.names)

    return hits.mapInArrow(run, schema)


def _insult_keys() -> np.ndarray:
    raw = [w.encode() for w in INSULTS]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(w) for w in raw])
    return np.sort(span_hashes(data, ends - [len(w) for w in raw], ends) & ~U64(7))


def lexicons_of(keys: np.ndarray, mined: np.ndarray, insults: np.ndarray) -> np.ndarray:
    """Number in LEXICONS of each key, -1 for candidates that are not mined."""
    kind = (keys & U64(7)).astype(np.int64)
    out = np.full(len(keys), -1)
    out[mined] = np.select([kind[mined] == 0, kind[mined] <= 2], [1, 2], 3)
    out[np.isin(keys, insults)] = 0
    return out


def posterior_sample(docs: DataFrame, voted: DataFrame, seen: list, post: np.ndarray, text: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label, text) of at most `rows` of all texts: of those with a label and of those without one, as many with a
    posterior above 1/2 as others, each time those of least hash.

    seen: (votes, y) of each pattern, post: its posterior, which becomes the label.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame([(int(r[0]), float(r[1]), float(p)) for r, p in zip(seen, post, strict=True)], "votes int, y double, __post double")  # at most 3 * 2**voters rows
    met = voted.where("doc_id IS NOT NULL").join(F.broadcast(known), ["votes", "y"]).select(F.col("doc_id").alias("__id"), "__post", "y")
    order = (F.xxhash64(F.lit(13), "__id"), "__id")
    parts = [met.where(F.col("y") >= 0 if labelled else F.col("y") < 0).where(f"__post {high} 0.5").orderBy(*order).limit(rows // 4) for labelled in (True, False) for high in (">", "<=")]
    least = parts[0].union(parts[1]).union(parts[2]).union(parts[3]).groupBy("__id").agg(F.max("__post").alias("label"))
    found = docs.select(F.col("doc_id").alias("__id"), F.col(text).alias("__text")).join(F.broadcast(least), "__id")  # `rows` ids at most
    return found.groupBy("__id").agg(F.first("label").alias("label"), F.min("__text").alias("text")).withColumnRenamed("__id", "doc_id")


def telling(sample: DataFrame) -> np.ndarray:
    """Keys that FEATURE_TEXTS texts of the sample hold and whose log odds by the posteriors reach FEATURE_LOG_ODDS."""
    n1, n0 = _sizes(sample)
    t, c = F.col("toxic"), F.col("n") - F.col("toxic")
    odds = F.log((t + 0.1) / (n1 - t + 0.1)) - F.log((c + 0.1) / (n0 - c + 0.1))
    return _keys(key_sums(sample).where((F.col("n") >= FEATURE_TEXTS) & (odds >= FEATURE_LOG_ODDS)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", fold: int = FOLD, folds: int = FOLDS) -> tuple[Model, LabelModel]:
    """The classifier and the label model."""
    labelled = checkpointed(labelled_sample(docs, labels, label, fold, folds, text=text))
    train = training_labels(labels, label, fold, folds).withColumnsRenamed({"__id": "doc_id", "label": "__y"})
    insults = _insult_keys()
    keys = np.unique(np.concatenate([lexicon_candidates(labelled), insults]))
    # One pass over all texts: which candidates each holds. Lexicons and votes follow from that.
    hits = checkpointed(key_hits(docs, keys, text))
    lexicon = lexicons_of(keys, mined_keys(hits, train, len(keys)), insults)
    voted = votes_of(hits, lexicon).join(train, "doc_id", "left").select("doc_id", "votes", F.coalesce((F.col("__y") > 0.5).cast("double"), F.lit(-1.0)).alias("y"))
    seen = [tuple(r) for r in voted.groupBy("votes", "y").count().collect()]
    packed, given, counts = (np.array([r[i] for r in seen]) for i in range(3)) if seen else (np.zeros(0, int), np.zeros(0), np.zeros(0))
    given = np.where(given < 0, np.nan, given.astype(float))
    model = fit_label_model(packed.astype(np.int64), given, counts, len(VOTERS))
    if not seen:
        return Model(np.zeros(0, U64), np.zeros(0), float(np.log(model.prior / (1 - model.prior))), True), model
    post = model.posterior(packed.astype(np.int64), given)
    sample = checkpointed(posterior_sample(docs, voted, seen, post, text))
    useful = docs.sparkSession.sparkContext.broadcast(telling(sample))  # from a bounded sample

    def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, key, value = word_features(data, offs)
        hit = np.isin(key, useful.value)
        return row[hit], key[hit], value[hit]

    _, target, rows = sample_features(sample, features, once=True)
    fitted = train_ftrl(rows, target, once=True, epochs=8, alpha=1.0, l1=3.0, l2=0.1)
    del rows
    trim()
    return for_share(fitted, target, float(np.clip((post * counts).sum() / counts.sum(), 1e-4, 0.5))), model


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", fold: int = FOLD, folds: int = FOLDS, threshold: float = THRESHOLD, names: tuple[str, str, str] = ("score", "predicted", "held_out")) -> DataFrame:
    """Append score (0 to 1, toxic likelier the higher), predicted and held_out to docs, under `names`."""
    model, _ = fit_toxicity(docs, labels, label, text, fold, folds)
    return scored(docs, model, word_features, text, fold, folds, threshold, names)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return toxicity_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "held_out", "score", "predicted")
