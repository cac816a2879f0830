"""Exact n-gram Jaccard join with set-relation skipping.

1. Equal sets are one class: their rows share a 128-bit hash of the set, and only one text of a class goes on.
2. Shingles are counted over all classes (exchange.py).  A set's tokens are ordered from rare to frequent; by the
   prefix principle two sets that link share one of their first n - ceil(t * n) + 1 tokens.  Tokens of one class
   only need no list, so a text with enough words of its own is done here.
3. Index lists of the remaining prefix tokens are sorted by set size and cut into blocks.  A token's position in a
   set bounds what the set can share with any other whose first common token it is, and so the sizes it can link
   with there: where the next size is beyond the reach of all sets so far, everything behind is skipped, and sets
   that reach none of their block leave it.  A block becomes a star, first in each partition, then over partitions;
   connected stars form groups outside of which nothing links.
4. Within a group overlaps are exact.  Sets are taken by size; if the overlaps of a very similar set are known, a
   set's own are derived from them by adding and taking away the few tokens in which the two differ.
5. Large groups are cut into chunks, each of which also gets PIVOTS sets of the group.  Sets that the links found so
   far leave outside of the group's main component are then compared with all chunks, block by block; pairs that
   the main component already connects are skipped.

No pair is emitted: groups send one edge for each set.  A class is known by the first 64 bits of its hash.
Texts without words have no set and are linked with nothing.  Null ids take part as the least of no component
unless all ids of it are null.  Repeated rows are members of one class.  Very long texts form a block of their own.
An empty table has no rows to return; other columns of docs take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import exchange as X
from quarry.llm.cluster import BATCH, checkpointed, in_batches, lean, text_bytes, trim
from quarry.llm.components import Forest, components, looked_up
from quarry.llm.textblocks import U64, blocks, lower, mix, rows_of, slices, span_hashes, whole_windows, window_hashes, words

SHINGLE = 5
#: A link needs PERCENT * union <= 100 * intersection.
PERCENT = 80
#: Sets and tokens of a group (or chunk) that one call compares.
GROUP_SETS = 192
GROUP_TOKENS = 200_000
PIVOTS = 8
#: Classes that one task remembers so as to send their text once only.
SEEN = 200_000
#: Tokens of a bin of groups, on average.
BIN_TOKENS = 1_000_000


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; texts of fewer than k words have their whole sequence as one."""
    data = lower(data)
    starts, ends, first = words(data, offs)
    h = span_hashes(data, starts, ends)
    at = whole_windows(first, k)
    keys = window_hashes(h, k)[at]
    cut = np.searchsorted(rows_of(first, at), np.arange(len(first)))
    count = np.diff(first)
    for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        keys[x:y].sort()
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    fresh[cut[:-1][cut[:-1] < len(keys)]] = True
    upto = np.concatenate([[0], np.cumsum(fresh)])[cut].tolist()
    keys = keys[fresh]
    short = {n: window_hashes(h, n) for n in range(1, k)}
    out = []
    for r, n in enumerate(count.tolist()):
        if n >= k:
            out.append(keys[upto[r] : upto[r + 1]])
        else:
            out.append(mix(short[n][first[r] : first[r] + 1] ^ U64(n)) if n else np.zeros(0, U64))
    return out


def set_hashes(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Two 64-bit hashes of each set; equal for equal sets."""
    size = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(size)
    out = []
    every = np.concatenate(sets) if len(full) else np.zeros(0, U64)
    begin = np.concatenate([[0], np.cumsum(size[full])[:-1]]).astype(np.int64) if len(full) else full
    for salt in (0, 0x8CB92BA72F3D8DD7):
        h = size.astype(U64)
        if len(full):
            h[full] ^= np.add.reduceat(mix(every ^ U64(salt)), begin)
        out.append(mix(h ^ U64(salt)).view(np.int64).tolist())
    return out[0], out[1]


def needed(n: np.ndarray | int, percent: int = PERCENT):
    """Tokens that a set of n shares at least with any set it links with."""
    return -(-n * percent // 100)


def classes(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """(doc_id, n, h1, h2, text): the text only where the task meets the class for the first time."""
    schema = docs.select(F.col(doc_id).alias("doc_id")).schema.add("n", "long").add("h1", "long").add("h2", "long").add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in slices(batches, 1):
            n, a, b, first = [], [], [], []
            for _, data, offs in blocks(batch.column(1)):
                sets = shingle_sets(data, offs, k)
                h1, h2 = set_hashes(sets)
                for s, h in zip(sets, zip(h1, h2, strict=True), strict=True):
                    n.append(len(s))
                    first.append(len(s) > 0 and h not in seen)
                    seen.add(h)
                a += h1
                b += h2
            if len(seen) > SEEN:
                seen.clear()
            texts = batch.column(1).take(pa.array(np.arange(len(first)), mask=~np.array(first, bool)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), texts], names=schema.names)
        seen.clear()
        trim()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


CANDIDATE = "id long, n long, tokens binary, prefix binary, reach binary"


def reach_of(n: int, at: np.ndarray, percent: int) -> np.ndarray:
    """The greatest size that a set of n can link with if the first common token is at place `at` of its order."""
    return np.minimum(((n - at) * (100 + percent) - n * percent) // percent, n * 100 // percent)


def _batch_sets(table: pa.Table, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(id, set) of the distinct classes of a batch, in order of id."""
    ids, h2 = np.asarray(table["h1"]), np.asarray(table["h2"])
    _, at = np.unique(np.stack([ids, h2]), axis=1, return_index=True)
    table = table.take(pa.array(at))
    ids, row = np.asarray(table["h1"]), 0
    for _, data, offs in blocks(table["text"]):
        for s in shingle_sets(data, offs, k):
            yield int(ids[row]), s
            row += 1


def candidates(rows: DataFrame, total: int, k: int, percent: int) -> DataFrame:
    """CANDIDATE rows: classes that share a prefix token with another class, with all tokens, those prefix tokens and how far each reaches.

    total: bytes of text at most, for the number of batches.
    """
    batches, n = in_batches(rows, ["h1"], total)

    def send(table: pa.Table) -> pa.Table:
        sets = [s for _, s in _batch_sets(table, k)]
        return X.sent(X.batch_of(table), *X.key_counts(np.concatenate(sets)), n, 255)

    def pick(table: pa.Table, totals: np.ndarray) -> pa.Table:
        ids, sets = zip(*_batch_sets(table, k), strict=True)
        cuts = np.cumsum([0, *map(len, sets)])
        flat = np.concatenate(sets)
        order, new = X.distinct(flat)
        counts = np.empty(len(flat), totals.dtype)
        counts[order] = np.repeat(totals, np.diff(np.append(new, len(flat))))
        del flat, order, new
        out: list[list] = [[], [], [], [], []]
        for i, s, x, y in zip(ids, sets, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            df, p = counts[x:y], len(s) - int(needed(len(s), percent)) + 1
            if int((df == 1).sum()) >= p:
                continue
            order = np.lexsort((s, df))[:p]
            at = np.flatnonzero(df[order] > 1)
            if len(at):
                for column, value in zip(out, (i, len(s), s.tobytes(), s[order[at]].tobytes(), reach_of(len(s), at, percent).tobytes()), strict=True):
                    column.append(value)
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["id", "n", "tokens", "prefix", "reach"])

    answered = X.answers(batches.groupBy(BATCH).applyInArrow(lean(send), X.SENT), 255)
    return checkpointed(X.told(batches, answered, pick, CANDIDATE, 255))


def _stars(token: np.ndarray, node: np.ndarray, least: np.ndarray, reach: np.ndarray, single: bool = False):
    """Blocks of index lists: each entry, the first of its block, and (token, first, least size, reach) of each block.

    single: entries are sets, not blocks; those that reach no size of their block leave it.
    """
    order = np.lexsort((least, token))
    token, node, least, reach = token[order], node[order], least[order], reach[order]
    for turn in range(2):
        if not len(token):
            return node, node, token, node, least, reach
        run = np.ones(len(token), bool)
        run[1:] = token[1:] != token[:-1]
        # The greatest reach so far within each list; sizes are below 2**40, lists are numbered.
        lift = np.cumsum(run).astype(np.int64) << 40
        cut = run
        cut[1:] |= (np.maximum.accumulate(reach + lift) - lift)[:-1] < least[1:]
        begin = np.flatnonzero(cut)
        size = np.diff(np.append(begin, len(node)))
        if turn or not single:
            break
        keep = reach >= np.repeat(least[begin], size)
        # A head that only smaller sets could link with stays where its list may go on in other partitions.
        keep |= cut
        token, node, least, reach = token[keep], node[keep], least[keep], reach[keep]
    return node, np.repeat(node[begin], size), token[begin], node[begin], least[begin], np.maximum.reduceat(reach, begin)


def candidate_edges(cand: DataFrame, percent: int) -> DataFrame:
    """(a, b): stars of the blocks of all index lists."""
    buckets = max(1, -(-int(cand.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0) // (8 * BIN_TOKENS)))
    schema = "a long, b long, bucket int, tokens binary, nodes binary, least binary, reach binary"
    names = ["a", "b", "bucket", "tokens", "nodes", "least", "reach"]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix, cuts = X.flat(pa.chunked_array([batch.column("prefix")]), U64)
            if not len(prefix):
                continue
            reach, size = X.flat(pa.chunked_array([batch.column("reach")]), np.int64)[0], np.diff(cuts)
            n = np.repeat(np.asarray(batch.column("n")), size)
            node, head, token, *rest = _stars(prefix, np.repeat(np.asarray(batch.column("id")), size), n, reach, True)
            edge = np.unique(np.stack([node, head])[:, node != head], axis=1)
            cuts = np.searchsorted(X.bucket_of(token, buckets), np.arange(buckets + 1))
            full = np.flatnonzero(cuts[1:] > cuts[:-1])
            cuts, e, m = np.append(cuts[full], len(token)), edge.shape[1], len(full)
            none = pa.nulls(e, pa.binary())
            ends = [pa.array(np.append(x, np.zeros(m, np.int64))) for x in edge]
            yield pa.RecordBatch.from_arrays([*ends, pa.array(np.append(np.full(e, -1), full).astype(np.int32)), *[pa.concat_arrays([none, X.runs(x, cuts)]) for x in (token, *rest)]], names=names)
        trim()

    def meet(table: pa.Table) -> pa.Table:
        node, head, *_ = _stars(X.flat(table["tokens"], U64)[0], *[X.flat(table[c], np.int64)[0] for c in ("nodes", "least", "reach")])
        edge = np.unique(np.stack([node, head])[:, node != head], axis=1)
        return pa.table({"a": edge[0], "b": edge[1]})

    spread = cand.select("id", "n", "prefix", "reach").mapInArrow(local, schema)
    far = spread.where("bucket >= 0").select("bucket", "tokens", "nodes", "least", "reach").groupBy("bucket").applyInArrow(lean(meet), "a long, b long")
    return spread.where("bucket < 0").select("a", "b").union(far)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, row by row.

    Rows are made in order of size.  If a set r with known row is very similar to x, row x is row r plus the
    lists of the tokens that only x has, minus those that only r has; else the lists of all tokens of x are added.
    """
    g = len(sets)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(g), [len(s) for s in sets])
    keys, at, count = np.unique(every, return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1  # tokens of one set only are in no intersection but its own
    keep = count[at] > 1
    lists = np.zeros((int((count > 1).sum()), g), np.uint8)
    lists[number[at[keep]], owner[keep]] = 1
    own = [number[x[count[x] > 1]] for x in np.split(at, np.cumsum([len(s) for s in sets])[:-1])]
    out = np.zeros((g, g), np.int64)
    done: list[int] = []
    for x in sorted(range(g), key=lambda i: (len(own[i]), i)):
        leader = done[int(np.argmax(out[done, x]))] if done else -1
        if leader >= 0 and len(own[x]) + len(own[leader]) - 2 * out[leader, x] < len(own[x]) // 2:
            more = np.setdiff1d(own[x], own[leader], assume_unique=True)
            less = np.setdiff1d(own[leader], own[x], assume_unique=True)
            out[x] = out[leader] + lists[more].sum(0, dtype=np.int64) - lists[less].sum(0, dtype=np.int64)
        else:
            out[x] = lists[own[x]].sum(0, dtype=np.int64)
        done.append(x)
    out[np.arange(g), np.arange(g)] = [len(s) for s in sets]
    return out


def linked(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Boolean matrix of the pairs that link."""
    both = overlaps(sets)
    n = np.diag(both)
    out = both * 100 >= percent * (n[:, None] + n[None, :] - both)
    np.fill_diagonal(out, False)
    return out


def _edges_within(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """One edge from each set to the first of its component."""
    f = Forest(len(ids))
    for i, j in np.argwhere(np.triu(linked(sets, percent))).tolist():
        f.join(i, j)
    return [(ids[i], ids[r]) for i, r in enumerate(f.roots().tolist()) if i != r]


def group_links(cand: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(a, b): edges that connect the sets of every component of links."""
    members = checkpointed(cand.join(groups, "id").select("comp", "id", "n", "tokens"))
    sizes = members.groupBy("comp").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("words"), *[F.min(F.struct(F.xxhash64(F.lit(i), "id"), "id")).alias(f"p{i}") for i in range(PIVOTS)])
    chunks = F.greatest(F.ceil(F.col("sets") / GROUP_SETS), F.least(F.ceil(F.col("words") / GROUP_TOKENS), F.ceil(F.col("sets") / 2))).cast("int")
    sizes = checkpointed(sizes.withColumn("chunks", chunks))
    placed = looked_up(members, "comp", sizes.select("comp", "chunks"), "id").withColumn("chunk", F.pmod(F.xxhash64(F.lit(77), "id"), F.col("chunks")).cast("int"))
    pivot_ids = sizes.where("chunks > 1").select("comp", "chunks", F.explode(F.array_distinct(F.array(*[F.col(f"p{i}.id") for i in range(PIVOTS)]))).alias("id"))
    pivots = members.join(pivot_ids, ["comp", "id"]).select("comp", "id", "n", "tokens", "chunks", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    dealt = placed.select("comp", "chunk", "id", "tokens").union(pivots.select("comp", "chunk", "id", "tokens"))
    tasks = max(1, -(-int(sizes.agg(F.sum("words")).first()[0] or 0) // BIN_TOKENS))
    dealt = dealt.withColumn("bin", F.pmod(F.xxhash64("comp", "chunk"), F.lit(tasks)).cast("int"))

    def within(table: pa.Table) -> pa.Table:
        comp, chunk, ids = (np.asarray(table[c]) for c in ("comp", "chunk", "id"))
        tokens, out = table["tokens"].to_pylist(), []
        order = np.lexsort((ids, chunk, comp))
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(comp[order]) != 0) | (np.diff(chunk[order]) != 0)]))
        for part in np.split(order, cut[1:]):
            _, at = np.unique(ids[part], return_index=True)  # a pivot may be of this chunk
            part = part[at]
            out += _edges_within(ids[part].tolist(), [np.frombuffer(tokens[i], U64) for i in part], percent)
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    near = checkpointed(dealt.groupBy("bin").applyInArrow(lean(within), "a long, b long"))
    big = sizes.where("chunks > 1").select("comp")
    if big.isEmpty():
        return near
    # Large groups: what links with none of the main component so far meets every chunk.
    wide = placed.where("chunks > 1").select("comp", "chunk", "chunks", "id", "tokens")
    label = components(near)
    named = wide.join(label.withColumnRenamed("comp", "label"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    share = named.groupBy("comp", "label").count()
    main = share.groupBy("comp").agg(F.max(F.struct("count", F.col("label").alias("main"))).alias("m"), F.sum("count").alias("all")).select("comp", F.col("m.main").alias("main"), (F.col("all") - F.col("m.count")).alias("rest"))
    main = main.where("rest > 0").withColumn("parts", F.ceil(F.col("rest") / (GROUP_SETS // 2)).cast("int"))
    ready = checkpointed(looked_up(named, "comp", main, "id"))
    rest = ready.where("label <> main").withColumn("part", F.pmod(F.xxhash64(F.lit(78), "id"), F.col("parts")).cast("int"))
    left = rest.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("comp", "chunk", "part", "id", "label", "tokens", F.lit(True).alias("asks"))
    right = ready.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("comp", "chunk", "part", "id", "label", "tokens", F.lit(False).alias("asks"))

    def across(table: pa.Table) -> pa.Table:
        ids, label, asks = np.asarray(table["id"]), np.asarray(table["label"]), np.asarray(table["asks"].combine_chunks().to_numpy(zero_copy_only=False), bool)
        sets = [np.frombuffer(t, U64) for t in table["tokens"].to_pylist()]
        yes = linked(sets, percent) & asks[:, None] & (label[:, None] != label[None, :])
        f, out = Forest(len(ids)), []
        for i, j in np.argwhere(yes).tolist():
            if f.root(i) != f.root(j):
                f.join(i, j)
                out.append((ids[i], ids[j]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return near.union(left.union(right).groupBy("comp", "chunk", "part").applyInArrow(lean(across), "a long, b long"))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of docs.

    component_id: the least doc_id reachable over links, the row's own included; without a set, the own id.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    rows = classes(docs, doc_id, text, k)
    cand = candidates(rows.where("text IS NOT NULL AND n > 0").select("h1", "h2", "text"), text_bytes(docs, text), k, percent)
    groups = components(candidate_edges(cand, percent))
    comp = components(group_links(cand, groups, percent))
    slim = checkpointed(rows.select("doc_id", "n", "h1", "h2"))
    least = slim.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("least"))
    named = checkpointed(least.join(comp.select(F.col("id").alias("h1"), "comp"), "h1", "left").withColumn("comp", F.coalesce("comp", "h1")))
    heads = named.groupBy("comp").agg(F.min("least").alias("head"))
    class_heads = looked_up(named, "comp", heads, "h1").select("h1", "h2", "n", "head")
    out = slim.join(class_heads, ["h1", "h2", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("head")).otherwise(F.col("doc_id")).alias("component_id"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Of each component of linked texts one row: that of the least doc_id, of several the one of least row hash.

    Rows with a null id or without words are kept as they are.  Rows of one id are judged each by its own text.
    """
    cols = docs.columns
    set_of = F.col(doc_id).isNotNull() & F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    own = docs.where(set_of).withColumn("__row", F.xxhash64(*cols))
    found = jaccard_components(own.select(F.struct(F.col(doc_id).alias("id"), F.col("__row").alias("row")).alias("__id"), F.col(text).alias("__text")), "__id", "__text", k, percent)
    first = found.where("component_id = doc_id").select(F.col("doc_id.id").alias("__first"), F.col("doc_id.row").alias("__row")).distinct()
    kept = own.join(first, (F.col(doc_id) == F.col("__first")) & (own["__row"] == first["__row"]), "left_semi")
    return kept.dropDuplicates([doc_id, "__row"]).select(*cols).union(docs.where(~set_of))


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
