"""Counting keys over all batches, and telling each batch the totals of its own keys.

A batch sends its sorted distinct keys with local counts, cut into runs by the leading bits of the key; run b of
every batch meets in bucket b, where equal keys are summed.  The bucket answers each batch with totals in the
order of the keys that it sent, so that no key travels back.  However often a key occurs, a bucket gets it at most
once from each batch: hot keys are summed up before the shuffle.

Batches and buckets are as many (cluster.batch_count); above 60 GB of text their number grows with the square root
of the data, so that a run keeps some hundred bytes.  Both are groups within as many partitions as the session
shuffles to.  Runs are slices of Arrow buffers; no Python object is made for each.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.cluster import BATCH, lean
from quarry.llm.textblocks import U64

#: Rows between batches and buckets: runs of keys (and the second halves of 128-bit keys) and counts one way, totals the other way.
SENT = f"bucket int, {BATCH} int, keys binary, others binary, counts binary"
ANSWERED = f"{BATCH} int, bucket int, totals binary"


def kind_of(top: int) -> type:
    """What counts are sent as; those above `top` count as `top`."""
    return np.uint8 if top < 256 else np.int64


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def runs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary array of values[cuts[i]:cuts[i + 1]] for each i, over one buffer."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def flat(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a binary column one after the other, and the first place of each row and of the end."""
    parts, cuts, at = [np.zeros(0, kind)], [np.zeros(1, np.int64)], 0
    for chunk in column.chunks:
        if not len(chunk):
            continue
        offs = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1].astype(np.int64)
        if offs[-1] > offs[0]:
            parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[offs[0] : offs[-1]].view(kind))
        cuts.append((offs[1:] - offs[0]) // np.dtype(kind).itemsize + at)
        at = int(cuts[-1][-1])
    return parts[1] if len(parts) == 2 else np.concatenate(parts), np.concatenate(cuts)


def sent(batch: int, keys: np.ndarray, counts: np.ndarray, buckets: int, top: int, others: np.ndarray | None = None) -> pa.Table:
    """Rows of SENT for sorted distinct keys."""
    cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
    full = np.flatnonzero(cuts[1:] > cuts[:-1])
    cuts = np.append(cuts[full], len(keys))
    counts = np.minimum(counts, top).astype(kind_of(top))
    none = pa.nulls(len(full), pa.binary())
    return pa.table([pa.array(full.astype(np.int32)), pa.array(np.full(len(full), batch, np.int32)), runs(keys, cuts), none if others is None else runs(others, cuts), runs(counts, cuts)], names=["bucket", BATCH, "keys", "others", "counts"])


def distinct(a: np.ndarray, b: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys a (or pairs a, b), and at which places of the ordered keys a new one begins."""
    order = np.argsort(a, kind="stable") if b is None else np.lexsort((b, a))
    a = a[order]
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    if b is not None:
        b = b[order]
        new[1:] |= b[1:] != b[:-1]
    return order, np.flatnonzero(new)


def answer(top: int, table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Rows of ANSWERED for the rows of SENT of one bucket, its distinct keys and their totals."""
    keys, cuts = flat(table["keys"], U64)
    others = flat(table["others"], U64)[0]
    order, new = distinct(keys, others if len(others) else None)
    counts = flat(table["counts"], kind_of(top))[0][order].astype(np.int64)
    sums = np.minimum(np.add.reduceat(counts, new), top).astype(kind_of(top)) if len(new) else np.zeros(0, kind_of(top))
    totals = np.empty(len(keys), kind_of(top))
    totals[order] = np.repeat(sums, np.diff(np.append(new, len(keys))))
    return pa.table([table[BATCH], table["bucket"], runs(totals, cuts)], names=[BATCH, "bucket", "totals"]), keys[order[new]], sums


def answers(sends: DataFrame, top: int) -> DataFrame:
    """Rows of ANSWERED for rows of SENT. A batch and bucket send one row at most."""
    return sends.groupBy("bucket").applyInArrow(lean(lambda t: answer(top, t)[0]), ANSWERED)


def totals_of(table: pa.Table, top: int) -> np.ndarray:
    """Totals of all keys of one batch, in the order of the sorted keys."""
    return flat(table.sort_by("bucket")["totals"], kind_of(top))[0]


def told(batches: DataFrame, answered: DataFrame, use: Callable[[pa.Table, np.ndarray], pa.Table], schema, top: int) -> DataFrame:
    """use(rows of the batch, totals of its keys) for every batch."""
    return batches.groupBy(BATCH).cogroup(answered.groupBy(BATCH)).applyInArrow(lean(lambda rows, a: use(rows, totals_of(a, top))), schema)


def key_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def batch_of(table: pa.Table) -> int:
    return table[BATCH][0].as_py()
