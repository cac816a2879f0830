"""Substring dedup with difference-cover anchors.

Any two equal windows of WINDOW words, wherever they begin, share an anchor: for a difference cover D modulo
PERIOD and begins i and j there is a k < PERIOD such that (i + k) mod PERIOD and (j + k) mod PERIOD are both in D.
So only the short windows of ANCHOR = WINDOW - PERIOD + 1 words that begin at cover positions are hashed and
counted over the corpus (a quarter of all positions).  Anchors that occur twice are then extended: the windows of
WINDOW words that contain one are hashed with 128 bits and counted in turn, and the words of windows that occur
twice or more, in any document, are removed.  False anchors cost time, never words.

Occurrences meet as counts (exchange.py): no pairs of documents are made, however many share a passage.
Texts are judged as given; nulls are empty texts, repeated rows repeat each other's windows, texts with fewer
than WINDOW words lose nothing, very long ones form a block of their own, and an empty table gives an empty result.
Columns of docs named n_words, n_removed or kept give way to those appended.  Windows are equal if 128 bits of two
independent hashes are: among 10**13 windows the chance of any wrong match is about 10**-13.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import exchange as X
from quarry.llm.cluster import BATCH, in_batches, lean, text_bytes
from quarry.llm.textblocks import SEEDS, blocks, rows_of, span_hashes, whole_windows, window_hashes, words

WINDOW = 35
#: A perfect difference set: all differences modulo 21 occur. Fixed values.
PERIOD = 21
COVER = (3, 6, 7, 12, 14)
#: Seeds of the second half of the 128-bit window hashes.
_OTHER = (SEEDS[1], 0xA0761D6478BD642F)


def cover_positions(first: np.ndarray, width: int, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> np.ndarray:
    """Word numbers at which an anchor of `width` words begins; positions count from the start of each text."""
    at = whole_windows(first, width)
    inside = at - first[rows_of(first, at)]
    return at[np.isin(inside % period, cover)]


def _anchors(data: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, first = words(data, offs)
    h = span_hashes(data, starts, ends)
    at = cover_positions(first, width)
    return starts, ends, first, at, window_hashes(h, width)[at]


def _windows(data, starts, ends, first, hit, window: int, width: int):
    """Begins of the windows that contain one of the anchors at `hit`, and their two hashes."""
    n = int(first[-1])
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, np.maximum(hit - (window - width), 0), 1)
    np.add.at(mark, np.minimum(hit + 1, n), -1)
    at = whole_windows(first, window)
    at = at[np.cumsum(mark)[at] > 0]
    h1 = window_hashes(span_hashes(data, starts, ends), window)
    h2 = window_hashes(span_hashes(data, starts, ends, _OTHER[0]), window, _OTHER[1])
    return at, h1[at], h2[at]


def substring_dedup(docs: DataFrame, keep: list[str], text: str = "text", window: int = WINDOW) -> DataFrame:
    """Columns `keep`, then n_words, n_removed, and kept: the words that stay, joined by one space."""
    width = window - PERIOD + 1
    if width < 1:
        raise ValueError(f"window must have {PERIOD} words at least")
    keep = [c for c in keep if c not in ("n_words", "n_removed", "kept")]
    kept = docs.select(*keep).schema
    schema = docs.select(*keep).schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")
    named = [f"__k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, named, strict=True)], F.col(text).alias("__text"))
    batches, n = in_batches(rows, ["__text", *named], text_bytes(docs, text))

    def send_anchors(table: pa.Table) -> pa.Table:
        got = [_anchors(d, o, width)[4] for _, d, o in blocks(table["__text"])]
        return X.sent(X.batch_of(table), *X.key_counts(np.concatenate(got)), n, 2)

    def candidates(table: pa.Table, totals: np.ndarray):
        """Of each block: its words, and the windows around anchors that occur twice."""
        keys = np.unique(np.concatenate([_anchors(d, o, width)[4] for _, d, o in blocks(table["__text"])]))
        twice = keys[totals >= 2]
        del keys
        for _, d, o in blocks(table["__text"]):
            starts, ends, first, at, key = _anchors(d, o, width)
            hit = at[np.isin(key, twice)] if len(twice) else at[:0]
            yield d, starts, ends, first, *_windows(d, starts, ends, first, hit, window, width)

    def send_windows(table: pa.Table, totals: np.ndarray) -> pa.Table:
        got = [(x[5], x[6]) for x in candidates(table, totals)]
        a, b = np.concatenate([x for x, _ in got]), np.concatenate([y for _, y in got])
        order, new = X.distinct(a, b)
        return X.sent(X.batch_of(table), a[order[new]], np.diff(np.append(new, len(a))), n, 2, b[order[new]])

    def remove(table: pa.Table, totals: np.ndarray, again: np.ndarray) -> pa.Table:
        got = [(x[4], x[5], x[6]) for x in candidates(table, totals)]
        a, b = np.concatenate([x[1] for x in got]), np.concatenate([x[2] for x in got])
        # The distinct pairs in the order in which they were sent, and which of them each window is.
        order, new = X.distinct(a, b)
        dup = np.zeros(len(a), bool)
        dup[order] = np.repeat(again >= 2, np.diff(np.append(new, len(a))))
        del a, b, order, new
        at, n_words, n_removed, texts = 0, [], [], []
        for (begin, _, _), (_, d, o) in zip(got, blocks(table["__text"]), strict=True):
            starts, ends, first = words(d, o)
            gone = begin[dup[at : at + len(begin)]]
            at += len(begin)
            mark = np.zeros(int(first[-1]) + 1, np.int64)
            np.add.at(mark, gone, 1)
            np.add.at(mark, gone + window, -1)
            out = np.cumsum(mark)[:-1] > 0
            raw = d.tobytes()
            for r in range(len(first) - 1):
                x, y = int(first[r]), int(first[r + 1])
                n_words.append(y - x)
                stay = np.flatnonzero(~out[x:y]) + x
                n_removed.append(y - x - len(stay))
                texts.append(b" ".join([raw[i:j] for i, j in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)]))
        cols = [table[c].cast(f.type) for c, f in zip(named, _arrow(kept, len(keep)), strict=True)]
        return pa.table([*cols, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())], names=schema.names)

    first_round = X.answers(batches.groupBy(BATCH).applyInArrow(lean(send_anchors), X.SENT), 2)
    none = X.sent(0, np.zeros(0, np.uint64), np.zeros(0, np.int64), n, 2)
    second = batches.groupBy(BATCH).cogroup(first_round.groupBy(BATCH)).applyInArrow(lean(lambda t, a: send_windows(t, X.totals_of(a, 2)) if len(t) else none), X.SENT)
    second_round = X.answers(second, 2)

    # Both rounds of answers go back together; `turn` tells them apart.
    back = first_round.select(BATCH, "bucket", "totals", F.lit(1).alias("turn")).unionByName(second_round.select(BATCH, "bucket", "totals", F.lit(2).alias("turn")))

    def finish(table: pa.Table, a: pa.Table) -> pa.Table:
        turn = np.asarray(a["turn"])
        return remove(table, X.totals_of(a.filter(pa.array(turn == 1)), 2), X.totals_of(a.filter(pa.array(turn == 2)), 2))

    return batches.groupBy(BATCH).cogroup(back.groupBy(BATCH)).applyInArrow(lean(finish), schema)


def _arrow(schema, n: int):
    from pyspark.sql.pandas.types import to_arrow_schema

    return [to_arrow_schema(schema).field(i) for i in range(n)]


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words that substring dedup removes from every document, and a digest of what stays."""
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


#: The same over DuckDB. Windows are compared by digests of their words joined by a space, which no word contains.
OP6_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT r, i, md5(array_to_string(list_slice(ws, i, i + 34), ' ')) AS win FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM d WHERE len(ws) >= 35)),
q AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY win) AS n FROM p) WHERE n > 1),
c AS (SELECT DISTINCT r, i + k AS i FROM q, (SELECT unnest(generate_series(0, 34)) AS k)),
x AS (SELECT r, i, word FROM (SELECT r, unnest(generate_series(1, len(ws))) AS i, unnest(ws) AS word FROM d)),
kept AS (SELECT x.r, count(*) AS n, string_agg(word, ' ' ORDER BY x.i) AS body FROM x ANTI JOIN c ON x.r = c.r AND x.i = c.i GROUP BY x.r)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(len(d.ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
