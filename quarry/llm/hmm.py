"""Hidden Markov language model over word classes, with word probabilities from corpus counts.

Every token belongs to one of CLASSES classes by a hash of its last bytes; the end of a text has a class of its
own.  A text's probability is that of its sequence of classes under a hidden Markov model, times the probability
of each token within its class: its smoothed count, count + 1/2, over the sum of those of the class, in which words
that no training text holds count as one more type of count 0.  So the classes of a state and the words of a class
each sum to 1 (the end is the only token of its class), and a score is the log probability of a text in a proper
distribution, in which unknown words of one class are one word.

Training: Baum-Welch.  Texts are tokenised once into classes, two bytes a token, which are checkpointed.  In each
iteration every partition runs the scaled forward-backward recursion over its whole training texts, those of an
Arrow batch going through numpy together in stretches of about CELLS tokens, and sends expected counts; they are
summed by Spark, cell by cell, so the driver holds STATES * (STATES + CLASSES) numbers whatever the corpus.  Every
training text takes part in every iteration.  Scoring runs the exact forward recursion over each whole text.

Token counts go through exchange.py: a batch sends its distinct tokens with local training counts and is told the
totals.  A token's key is 55 bits of a hash and its class; two of 10**10 distinct words share a key in about three
cases, whose counts are then added up.  Nulls are empty texts, which consist of their end; null ids count as
training rows; repeated rows count as often as they occur; very long texts go through in stretches like others.
Without training texts the class model is uniform.  An empty table has no scores.  Other columns of docs take no
part and are not returned, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import exchange as X
from quarry.llm.cluster import BATCH, checkpointed, in_batches, lean, text_bytes, trim
from quarry.llm.linear import held_out
from quarry.llm.textblocks import U64, blocks, lower, slices, span_hashes, words

STATES = 8
#: A power of two. The last class is that of the end.
CLASSES = 512
ITERATIONS = 3
#: Tokens of a training stretch: all states of so many are held at once.
CELLS = 1 << 18
FOLD, FOLDS = 1, 5
#: Key of the end token: no word has its class.
END = U64(CLASSES - 1)
_TAIL = 3


def _tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, first word of each row, and the class of each word."""
    starts, ends, first = words(data, offs)
    tail = np.maximum(starts, ends - _TAIL)
    kind = (span_hashes(data, tail, ends) % U64(CLASSES - 1)).astype(np.int64) if len(starts) else np.zeros(0, np.int64)
    return starts, ends, first, kind


def _with_end(values: np.ndarray, first: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """Values of words with one more at the end of each row, and the first place of each row."""
    rows = len(first) - 1
    at = first + np.arange(rows + 1)
    out = np.empty(len(values) + rows, values.dtype)
    last = np.zeros(len(out), bool)
    last[at[1:] - 1] = True
    out[last], out[~last] = end, values
    return out, at


def _steps(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of texts, longest first, and how many texts have each step."""
    length = np.diff(at)
    order = np.argsort(-length, kind="stable")
    top = int(length.max()) if len(length) else 0
    return at[:-1][order], len(length) - np.searchsorted(np.sort(length), np.arange(top), "right")


class Hmm:
    """start (S), move (S, S) and emit (S, C); rows sum to 1."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @staticmethod
    def initial(share: np.ndarray, states: int = STATES, seed: int = 5) -> Hmm:
        """Emissions around the classes' shares, each state favouring its own classes; states tend to stay."""
        rng = np.random.default_rng(seed)
        emit = share * rng.gamma(0.5, 2.0, (states, len(share))) + 1e-9
        move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
        return Hmm(np.full(states, 1 / states), move, emit / emit.sum(1, keepdims=True))

    def counts(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions of texts of one length, (texts, length)."""
        n, t = kinds.shape
        return self.expected(kinds.ravel(), t * np.arange(n + 1))

    def expected(self, kinds: np.ndarray, at: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions of whole texts, kinds[at[r]:at[r + 1]], by scaled forward-backward.

        Texts go together, longest first, one place a step. Steps are cut into stretches of about `cells` tokens: the
        forward pass keeps its state before each stretch only, and the backward pass runs each stretch forward again.
        """
        s, c = self.emit.shape
        begin, live = _steps(at)
        seen = np.ascontiguousarray(self.emit.T)
        start, move, emit = np.zeros(s), np.zeros((s, s)), np.zeros((c, s))
        off = np.concatenate([[0], np.cumsum(live)])
        cuts = [0]
        while cuts[-1] < len(live):
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(off, off[cuts[-1]] + cells, "right")) - 1))

        def forward(x: int, y: int, a: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            """Classes, their probabilities by state, alpha and scale at steps x to y, one below the other."""
            n = live[x:y]
            row = np.arange(off[y] - off[x]) - np.repeat(off[x:y] - off[x], n)
            k = kinds[begin[row] + np.repeat(np.arange(x, y), n)]
            e = seen[k]
            alpha, scale = np.empty_like(e), np.empty((len(k), 1))
            for i in range(x, y):
                p, q = off[i] - off[x], off[i + 1] - off[x]
                a = (a[: q - p] @ self.move if i else self.start) * e[p:q]
                np.sum(a, axis=1, keepdims=True, out=scale[p:q])
                a = np.divide(a, scale[p:q], out=alpha[p:q])
            return k, e, alpha, scale

        kept: list[np.ndarray | None] = [None]
        for x, y in itertools.pairwise(cuts):
            last = forward(x, y, kept[-1])
            kept.append(last[2][off[y - 1] - off[x] :].copy())
        beta = np.zeros((0, s))  # of the step after, before its emission: what the next loop hands back
        for j in range(len(cuts) - 2, -1, -1):
            x, y = cuts[j], cuts[j + 1]
            k, e, alpha, scale = last if y == len(live) else forward(x, y, kept[j])
            e /= scale
            post = np.empty_like(alpha)
            for i in range(y - 1, x - 1, -1):
                p, q = off[i] - off[x], off[i + 1] - off[x]
                b = post[p:q]  # beta first; texts that end here have 1
                b[: len(beta)], b[len(beta) :] = beta, 1
                w = np.multiply(e[p:q], b, out=e[p:q])
                if i:
                    beta = w @ self.move.T
            # Moves into steps x to y, from the step before each.
            n = live[x:y]
            if x:
                move += kept[j][: n[0]].T @ e[: n[0]]
            if y - x > 1:
                row = np.arange(n[0], len(k)) - np.repeat(off[x + 1 : y] - off[x], n[1:])
                move += alpha[row + np.repeat(off[x : y - 1] - off[x], n[1:])].T @ e[n[0] :]
            post *= alpha
            if not x:
                start = post[: n[0]].sum(0) if len(n) else start
            for state in range(s):
                emit[:, state] += np.bincount(k, post[:, state], c)
        return start, move * self.move, emit.T

    @staticmethod
    def updated(start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Hmm:
        start, move, emit = start + 1, move + 1, emit + 10 * share + 1e-9
        return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    def log10(self, kinds: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 probability of each row of classes, kinds[at[r]:at[r + 1]], by the scaled forward recursion."""
        length = np.diff(at)
        order = np.argsort(-length, kind="stable")
        begin, size = at[:-1][order], length[order]
        out = np.zeros(len(order))
        seen = np.ascontiguousarray(self.emit.T)
        live = len(order)
        a = np.tile(self.start, (live, 1))
        for i in range(int(size[0]) if live else 0):
            while size[live - 1] <= i:
                live -= 1
            a = a[:live] @ self.move if i else a
            a = a * seen[kinds[begin[:live] + i]]
            total = a.sum(1)
            out[:live] += np.log10(total)
            a /= total[:, None]
        back = np.empty(len(order))
        back[order] = out
        return back


def class_runs(docs: DataFrame, doc_id: str, text: str, fold: int, folds: int) -> DataFrame:
    """(kinds binary): the classes of each training text, its end included, as 16-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            out = [np.zeros(0, np.int16)]
            cuts = [np.zeros(1, np.int64)]
            for _, data, offs in blocks(batch.column(0)):
                _, _, first, kind = _tokens(lower(data), offs)
                k, at = _with_end(kind.astype(np.int16), first, CLASSES - 1)
                out.append(k)
                cuts.append(at[1:] + cuts[-1][-1])
            yield pa.RecordBatch.from_arrays([X.runs(np.concatenate(out), np.concatenate(cuts))], names=["kinds"])
        trim()

    return docs.where(~held_out(doc_id, fold, folds)).select(F.col(text)).mapInArrow(run, "kinds binary")


def baum_welch(train: DataFrame, model: Hmm, share: np.ndarray) -> Hmm:
    """One iteration over all training texts, train (kinds)."""
    s = len(model.start)
    cells = s + s * s + s * CLASSES
    shared = train.sparkSession.sparkContext.broadcast(model)  # STATES * (STATES + CLASSES) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for batch in batches:
            got = shared.value.expected(*X.flat(pa.chunked_array([batch.column(0)]), np.int16))
            total += np.concatenate([y.ravel() for y in got])
        trim()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(total)], names=["i", "n"])

    total = np.zeros(cells)
    for r in train.mapInArrow(run, "i long, n double").groupBy("i").agg(F.sum("n").alias("n")).collect():
        total[r["i"]] = r["n"]
    return Hmm.updated(total[:s], total[s : s + s * s].reshape(s, s), total[s + s * s :].reshape(s, CLASSES), share)


def class_mass(tokens: np.ndarray, types: np.ndarray) -> np.ndarray:
    """Smoothed counts of all words of each class; each but that of the end has one unknown type."""
    mass = tokens + 0.5 * types + 0.5
    mass[-1] = tokens[-1] + 0.5
    return mass


def language_model_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fold: int = FOLD, folds: int = FOLDS, iterations: int = ITERATIONS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each row of docs."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id, fold, folds).alias("held_out"), F.col(text).alias("__text"))
    batches, n = in_batches(rows, ["doc_id", "__text"], text_bytes(docs, text))
    top = 2**62

    def keys_of(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each block: keys of all tokens, their classes, first places and whether rows are training rows."""
        out = np.asarray(table["held_out"].combine_chunks().to_numpy(zero_copy_only=False), bool)
        for row, data, offs in blocks(table["__text"]):
            data = lower(data)
            starts, ends, first, kind = _tokens(data, offs)
            keys, at = _with_end(span_hashes(data, starts, ends) & ~END | kind.astype(U64), first, END)
            kinds, _ = _with_end(kind.astype(np.int16), first, CLASSES - 1)
            yield keys, kinds, at, ~out[row : row + len(offs) - 1]

    def send(table: pa.Table) -> pa.Table:
        got = [(k, np.repeat(t, np.diff(at))) for k, _, at, t in keys_of(table)]
        keys, at = np.unique(np.concatenate([k for k, _ in got]), return_inverse=True)
        return X.sent(X.batch_of(table), keys, np.bincount(at, np.concatenate([t for _, t in got])).astype(np.int64), n, top)

    def answer(table: pa.Table) -> pa.Table:
        out, keys, sums = X.answer(top, table)
        # One row more for the sums of this bucket, training tokens and types by class: batch -1.
        kind = (keys & END).astype(np.int64)
        by = np.concatenate([np.bincount(kind, sums, CLASSES), np.bincount(kind, sums > 0, CLASSES)]).astype(np.int64)
        extra = pa.table({BATCH: pa.array([-1], pa.int32()), "bucket": table["bucket"][:1], "totals": X.runs(by, np.array([0, len(by)]))})
        return pa.concat_tables([out, extra.cast(out.schema)])

    answered = checkpointed(batches.groupBy(BATCH).applyInArrow(lean(send), X.SENT).groupBy("bucket").applyInArrow(lean(answer), X.ANSWERED))
    sums = np.zeros((2, CLASSES), np.int64)
    for r in answered.where(F.col(BATCH) == -1).select("totals").mapInArrow(_class_sums, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        sums[r["i"] // CLASSES, r["i"] % CLASSES] = r["n"]
    total, distinct = int(sums[0].sum()), int(sums[1].sum())

    mass = class_mass(*sums)
    share = (sums[0] + 0.5) / (total + 0.5 * CLASSES)
    model = Hmm.initial(share)
    if total:
        train = checkpointed(class_runs(docs, doc_id, text, fold, folds))
        for _ in range(iterations):
            model = baum_welch(train, model, share)
    else:
        model = Hmm(model.start, model.move, np.tile(share, (len(model.start), 1)))
    floor = np.log10(total + 0.5 * (distinct + 1))
    shared = docs.sparkSession.sparkContext.broadcast((model, np.log10(mass)))

    def use(table: pa.Table, totals: np.ndarray) -> pa.Table:
        hmm, log_mass = shared.value
        every = np.unique(np.concatenate([k for k, *_ in keys_of(table)]))
        n_tokens, n_known, base, score = [], [], [], []
        for keys, kinds, at, _ in keys_of(table):
            c = totals[np.searchsorted(every, keys)]
            n_tokens.append(np.diff(at))
            n_known.append(np.add.reduceat((c > 0).astype(np.int64), at[:-1]))
            own = np.log10(c + 0.5)
            base.append(np.add.reduceat(own - floor, at[:-1]))
            score.append(hmm.log10(kinds, at) + np.add.reduceat(own - log_mass[kinds], at[:-1]))
        cat = np.concatenate
        return pa.table({"doc_id": table["doc_id"], "held_out": table["held_out"], "n_tokens": cat(n_tokens), "n_known": cat(n_known), "train_tokens": np.full(len(table), total, np.int64), "base_score": cat(base), "score": cat(score)})

    schema = docs.select(F.col(doc_id).alias("doc_id")).schema.add("held_out", "boolean").add("n_tokens", "long").add("n_known", "long").add("train_tokens", "long").add("base_score", "double").add("score", "double")
    return X.told(batches, answered.where(F.col(BATCH) >= 0), use, schema, top)


def _class_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(2 * CLASSES, np.int64)
    for batch in batches:
        total += X.flat(pa.chunked_array([batch.column(0)]), np.int64)[0].reshape(-1, 2 * CLASSES).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * CLASSES)), pa.array(total)], names=["i", "n"])


def op7_hmm_scores(spark, sf_dir: str) -> DataFrame:
    """Unigram and hidden Markov scores of every document."""
    return language_model_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
