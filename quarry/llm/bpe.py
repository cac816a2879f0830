"""Byte-level BPE encoding and decoding with padded numpy matrices.

The pieces of a text (matches of the split pattern) are encoded once per distinct piece and process: pieces
that no cache holds are put in matrices by length, one row a piece, padded with -1.  In each round every row
merges its leftmost pair of least rank; ranks of pairs come from an open hash table in numpy, and the row is
compacted.  Rows without a mergeable pair leave the matrix.  Pieces longer than LONG_PIECE bytes (runs without any
split, in none of the test tables' prose) would need as many rounds as bytes over rows as long, quadratic work, so a
heap over a linked list merges those, with the same result.

A piece that is a token as a whole is merged like others: in the vocabularies of byte pairs that this is for, every
token is what its own bytes merge to; ByteBPE.whole() checks that, and pieces of tokens that fail it are looked up.

Nulls count as empty texts; an empty text has no ids.  Repeated rows get the same ids, an empty table stays empty, a
very long text is split by itself.  Extra columns pass through untouched.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.cluster import trim
from quarry.llm.textblocks import slices

#: Distinct pieces that a task keeps; beyond this number the cache starts anew.
CACHE_PIECES = 100_000
#: Bytes from which a piece is merged by the heap.
LONG_PIECE = 192
#: Cells of one matrix.
MATRIX_CELLS = 1 << 18
_NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class ByteBPE:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, bytes] = {}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        tokens: list[bytes] = [b""] * size
        for t, r in ranks.items():
            tokens[r] = t
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.firsts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self._fill(np.array(pairs or [(0, 0, 0)], np.int64)[: len(pairs)])
        self.exceptions = self.whole()

    def _fill(self, pairs: np.ndarray) -> None:
        """Open addressing: keys that find their slot taken move on by one until all have a place."""
        bits = max(4, int(np.ceil(np.log2(max(2, len(pairs)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32)
        key = pairs[:, 0] << 32 | pairs[:, 1]
        slot, value = self._slot(key), pairs[:, 2].astype(np.int32)
        self.probes = 0
        while len(key):
            self.probes += 1
            free = self.keys[slot] == -1
            self.keys[slot[free]] = key[free]  # of several, the last stays
            placed = self.keys[slot] == key
            self.values[slot[placed]] = value[placed]
            key, value, slot = key[~placed], value[~placed], (slot[~placed] + 1) & self.mask

    def whole(self) -> dict[str, bytes]:
        """Tokens that their own bytes do not merge to; as whole pieces they still are one token."""
        names = [t for t in self.ranks if len(t) > 1]
        out: dict[str, bytes] = {}
        size = np.array([len(t) for t in names], np.int64)
        for n in np.unique(size).tolist():
            part = [names[i] for i in np.flatnonzero(size == n)]
            for at in range(0, len(part), max(1, MATRIX_CELLS // n)):
                some = part[at : at + max(1, MATRIX_CELLS // n)]
                for t, k in zip(some, self._merge_matrix(some, n)[1].tolist(), strict=True):
                    if k != 1:
                        try:
                            out[t.decode()] = np.array([self.ranks[t]], "<u4").tobytes()
                        except UnicodeDecodeError:
                            pass  # pieces are texts
        return out

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NONE where the two do not merge."""
        key = left.astype(np.int64) << 32 | right
        slot = self._slot(key)
        out = np.full(len(key), _NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        for _ in range(self.probes):
            found = self.keys[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (found != -1)]
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) & self.mask
        return out

    def _merge_matrix(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has."""
        n = len(pieces)
        length = np.array([len(p) for p in pieces], np.int64)
        ids = np.full((n, width), -1, np.int32)
        inside = np.arange(width) < length[:, None]
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full((n, width), _NONE, np.int32)
        if width > 1:
            rank[:, :-1] = self._rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        done = np.full((n, width), -1, np.int32)
        names = np.arange(n)
        while len(ids):
            at = rank.argmin(1)  # the leftmost of the least
            rows = np.arange(len(ids))
            least = rank[rows, at]
            go = least != _NONE
            if not go.all():
                done[names[~go], : ids.shape[1]] = ids[~go]
                ids, rank, length, names, at, least = ids[go], rank[go], length[go], names[go], at[go], least[go]
                rows = rows[: len(ids)]
                if not len(ids):
                    break
            ids[rows, at] = least
            col = np.arange(ids.shape[1] - 1)
            move = col >= at[:, None] + 1
            np.copyto(ids[:, :-1], ids[:, 1:].copy(), where=move)
            np.copyto(rank[:, :-1], rank[:, 1:].copy(), where=move)
            ids[:, -1], rank[:, -1] = -1, _NONE
            length -= 1
            right = np.where(at + 1 < ids.shape[1], ids[rows, np.minimum(at + 1, ids.shape[1] - 1)], -1)
            rank[rows, at] = self._rank(ids[rows, at], right)
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self._rank(ids[left, at[left] - 1], ids[left, at[left]])
            keep = int(length.max())
            if keep < ids.shape[1]:
                ids, rank = np.ascontiguousarray(ids[:, :keep]), np.ascontiguousarray(rank[:, :keep])
        used = done >= 0
        return done[used], used.sum(1)

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = [int(self.byte_ids[b]) for b in piece]
        ends, n = [i + 1 for i in range(len(ids))], len(ids)
        before, after, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        rank = lambda i: self.ranks.get(piece[i : ends[after[i]]]) if after[i] < n else None
        heap = [(r, i, after[i]) for i in range(n) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        version = list(ends)
        while heap:
            r, i, j = heapq.heappop(heap)
            if not alive[i] or after[i] != j or j >= n or rank(i) != r:
                continue
            ids[i], ends[i], alive[j], after[i] = r, ends[j], False, after[j]
            version[i] = ends[i]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(heap, (r, k, after[k]))
        return np.array([ids[i] for i in range(n) if alive[i]], np.int32)

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of distinct pieces as little-endian 32-bit integers."""
        names = list(pieces)
        raw = [p.encode("utf-8", "surrogatepass") for p in names]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(size, kind="stable")
        sizes = size[order]
        out: dict[str, bytes] = {}
        at = 0
        while at < len(order) and sizes[at] <= LONG_PIECE:
            width = max(1, int(sizes[at]))
            width = -(-width // 2) * 2 if width <= 32 else -(-width // 16) * 16
            to = min(int(np.searchsorted(sizes, width, "right")), at + max(1, MATRIX_CELLS // width))
            part = order[at:to].tolist()
            ids, n = self._merge_matrix([raw[i] for i in part], width)
            flat, ends = ids.astype("<u4").tobytes(), (np.cumsum(n) * 4).tolist()
            begin = 0
            for i, end in zip(part, ends, strict=True):
                out[names[i]] = flat[begin:end]
                begin = end
            at = to
        for i in order[at:].tolist():
            out[names[i]] = self._merge_long(raw[i]).astype("<u4").tobytes()
        return out

    def encode_batch(self, texts: list[str], limit: int = 1 << 20) -> Iterator[bytes]:
        """Ids of each text, in order; about `limit` characters are split at once."""
        at = 0
        while at < len(texts):
            to, chars = at, 0
            while to < len(texts) and (to == at or chars + len(texts[to]) <= limit):
                chars += len(texts[to])
                to += 1
            split = [self.pattern.findall(t) for t in texts[at:to]]
            if len(self.cache) > CACHE_PIECES:
                self.cache.clear()
            cache = self.cache
            new = set()
            for s in split:
                new.update(s)
            new.difference_update(cache)
            cache.update(self.encode_pieces(new))
            cache.update({p: self.exceptions[p] for p in new & self.exceptions.keys()} if self.exceptions else {})
            for s in split:
                yield b"".join(map(cache.__getitem__, s))
            at = to

    def decode(self, ids: bytes) -> bytes:
        """The bytes of a run of ids."""
        a = np.frombuffer(ids, "<u4").astype(np.int64)
        if not len(a):
            return b""
        n = self.lengths[a]
        ends = np.cumsum(n)
        return self.bytes[np.repeat(self.firsts[a] - (ends - n), n) + np.arange(ends[-1])].tobytes()


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(read_ranks(path), pattern)


def _default() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append `ids` array<int>: the token ids of the whole text. A null or empty text has none."""
    path, pattern = path or _default()[0], pattern or _default()[1]

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = tokenizer(path, pattern)
        for part in texts:
            yield pd.Series([np.frombuffer(x, "<u4").astype(np.int32) for x in bpe.encode_batch(part.fillna("").tolist())], dtype=object)
        bpe.cache.clear()

    return docs.withColumn(ids, run(F.col(text)))


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """Append `decoded` binary: the bytes of the ids. Null ids give empty bytes; unknown ids raise IndexError."""
    path, pattern = path or _default()[0], pattern or _default()[1]

    @F.pandas_udf(T.BinaryType())
    def run(arrays: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = tokenizer(path, pattern)
        for part in arrays:
            yield pd.Series([b"" if x is None else bpe.decode(np.asarray(x, "<u4").tobytes()) for x in part], dtype=object)

    return encoded.withColumn(data, run(F.col(ids)))


#: What round_trip() appends.
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, keep: list[str], path: str | None = None, pattern: str | None = None, text: str = "text", with_ids: bool = False) -> DataFrame:
    """Columns `keep`, then n_tokens and SHA-256 of the ids (little-endian 32 bits) and of the decoded bytes.

    Encodes and decodes in one pass over the text, so that ids leave the worker only if asked for (column ids).
    Columns of docs that are named like those appended give way to them.
    """
    keep = [c for c in keep if c not in ("n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] * with_ids))]
    path, pattern = path or _default()[0], pattern or _default()[1]
    kept = docs.select(*keep).schema
    schema = T.StructType([*kept.fields, *T._parse_datatype_string(DIGESTS + ", ids array<int>" * with_ids).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, pattern)
        for batch in slices(batches, -1):
            n, a, b, ids = [], [], [], []
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            for x in bpe.encode_batch(texts):
                n.append(len(x) // 4)
                a.append(hashlib.sha256(x).hexdigest())
                b.append(hashlib.sha256(bpe.decode(x)).hexdigest())
                if with_ids:
                    ids.append(x)
            cols = [*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
            if with_ids:
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), flat))
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)
        bpe.cache.clear()  # the worker goes on to other stages
        trim()

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
