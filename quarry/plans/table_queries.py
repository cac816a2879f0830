"""Queries over tables: sources, sampling, joins, packing, metrics, preference numerics and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import arrays as M
from quarry.functions import scores as C
from quarry.functions.text import media_kind
from quarry.operators import joins as J
from quarry.operators import metrics as A
from quarry.operators import packing as K
from quarry.operators import preprocess as P
from quarry.operators import rejection as G
from quarry.operators import rl as R
from quarry.operators import sampling as L
from quarry.plans.registry import query, table
from quarry.sources.catalog import Catalog, Dataset, Subset
from quarry.sources.readers import load_dataset, metrics_long
from quarry.sources.syntax import parse
from quarry.streaming import streams as S

# Sources.


@query("s1_parsed_specs", "SELECT * FROM (VALUES ('hf', 'org/data', 'a,b', 5), ('ms', 'x', '', -1), ('', 'plain', 'all', -1), ('', 'p', '', 12)) t(hub, source, subsets, n)")
def parsed_specs(spark, d):
    specs = [parse(s, lambda _: False) for s in ("HF::org/data:a/b#5", "ms::x", "plain:all", "p#12")]
    return spark.createDataFrame([(s.hub or "", s.source, ",".join(s.subsets), -1 if s.rows is None else s.rows) for s in specs], "hub string, source string, subsets string, n int")


@query("s4_subsets", "SELECT * FROM (VALUES ('none', 'default'), ('all', 'default,extra'), ('named', 'weak'), ('unknown', 'zz')) t(ask, chosen)")
def subsets(spark, d):
    one = Dataset("d", subsets=(Subset(), Subset("extra", "extra"), Subset("weak", "weak", weak=True)))
    rows = [(k, ",".join(s.name for s in Catalog.choose(one, n))) for k, n in (("none", ()), ("all", ("all",)), ("named", ("weak",)), ("unknown", ("zz",)))]
    return spark.createDataFrame(rows, "ask string, chosen string")


def _catalog(d: str) -> Catalog:
    c = Catalog()
    pick = lambda df: df.select("doc_id", P.message("user", F.col("lang")).alias("u"), P.message("assistant", F.col("source")).alias("a")).select("doc_id", F.array("u", "a").alias("messages"))
    c.register(Dataset("docs", path=f"{d}/documents.parquet", prepare=pick))
    return c


SHUFFLED = "row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1"


@query("s8_load_and_split", f"SELECT doc_id, CASE WHEN i < greatest(n // 10, 1) THEN 'val' ELSE 'train' END AS part, 'docs' AS dataset FROM (SELECT doc_id, {SHUFFLED} AS i, count(*) OVER () AS n FROM documents)")
def load_and_split(spark, d):
    train, val = load_dataset(spark, "docs", split_ratio=0.1, key="doc_id", catalog=_catalog(d))
    pick = lambda df, name: df.select("doc_id", F.lit(name).alias("part"), "dataset")
    return pick(train, "train").unionByName(pick(val, "val"))


@query("s8_sampled_and_shuffled", f"SELECT doc_id, i - 15 AS place, 'docs' AS dataset FROM (SELECT doc_id, {SHUFFLED} AS i FROM documents) WHERE i BETWEEN 15 AND 149")
def sampled_and_shuffled(spark, d):
    train, _ = load_dataset(spark, "docs#150", split_ratio=0.1, shuffle=True, key="doc_id", catalog=_catalog(d))
    return L.shuffled(train, "doc_id", name="place").select("doc_id", "place", "dataset")


@query("s9_cached_lengths", "SELECT doc_id, n_chars FROM documents WHERE n_chars <= 500")
def cached_lengths(spark, d):
    df = table(spark, d, "documents").withColumn("lengths", F.array("n_chars", F.lit(1).cast("long")))
    return df.where(F.array_max("lengths") <= 500).select("doc_id", "n_chars")


@query("s12_media_kinds", """SELECT page_id, CASE WHEN e IN ('jpg','jpeg','png','gif','bmp','webp','tiff') THEN 'image' WHEN e IN ('mp4','avi','mkv','mov','webm','flv','mpeg') THEN 'video' WHEN e IN ('mp3','wav','flac','ogg','m4a','aac') THEN 'audio' ELSE 'other' END AS kind
FROM (SELECT page_id, ['jpg', 'MP4', 'wav', 'txt'][page_id % 4 + 1] AS x, lower(['jpg', 'MP4', 'wav', 'txt'][page_id % 4 + 1]) AS e FROM pages)""")
def media_kinds(spark, d):
    ext = F.get(F.array(*[F.lit(x) for x in ("jpg", "MP4", "wav", "txt")]), (F.col("page_id") % 4).cast("int"))
    return table(spark, d, "pages").select("page_id", media_kind(F.concat("url", F.lit("/f."), ext, F.lit("?q=1"))).alias("kind"))


@query("s14_long_metrics", "SELECT c_custkey, 'c_acctbal' AS metric, c_acctbal AS value FROM customer UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer")
def long_metrics(spark, d):
    return metrics_long(table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_name"), ["c_custkey"])


@query("s15_leaderboard", "SELECT o_orderpriority, o_orderstatus, round(avg(o_totalprice), 4) AS value, count(o_totalprice) AS n FROM orders GROUP BY ALL")
def leaderboard(spark, d):
    return A.leaderboard(table(spark, d, "orders"), ["o_orderpriority", "o_orderstatus"], "o_totalprice").withColumn("value", F.round("value", 4))


@query("s16_resampled", "SELECT doc_id FROM documents WHERE n_chars > 300 ORDER BY doc_id LIMIT 50")
def resampled(spark, d):
    return L.resample(table(spark, d, "documents").withColumn("ok", F.col("n_chars") > 300), "ok", "doc_id", 50).select("doc_id")


@query("s18_shards", "SELECT doc_id, CAST(floor(((i + 1) * 7 - 1) / n) AS BIGINT) AS shard, i % 7 AS strided FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)")
def shards(spark, d):
    df = table(spark, d, "documents").select("doc_id")
    return L.shard(df, "doc_id", 7).select("doc_id", "shard").join(L.shard(df, "doc_id", 7, strided=True).select("doc_id", F.col("shard").alias("strided")), "doc_id")


# Sampling and mixing.


@query("l1_sampled_with_repeats", f"WITH s AS (SELECT doc_id, {SHUFFLED} AS i, count(*) OVER () AS n FROM documents) SELECT doc_id, CAST(k AS INTEGER) AS copy FROM s, range(3) t(k) WHERE k < 2 OR i < 100")
def sampled_with_repeats(spark, d):
    df = table(spark, d, "documents").select("doc_id")
    return L.sample(df, 2 * df.count() + 100, "doc_id")


@query("l2_split", f"SELECT doc_id, i < greatest(n // 20, 1) AS val FROM (SELECT doc_id, {SHUFFLED} AS i, count(*) OVER () AS n FROM documents)")
def split(spark, d):
    train, val = L.split(table(spark, d, "documents").select("doc_id"), 0.05, "doc_id")
    return train.select("doc_id", F.lit(False).alias("val")).unionByName(val.select("doc_id", F.lit(True).alias("val")))


@query("l3_take_skip", "SELECT doc_id, i < 20 AS val FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) WHERE i < 100")
def take_skip(spark, d):
    train, val = L.take_skip(table(spark, d, "documents").select("doc_id"), "doc_id", 100, 0.2)
    return train.select("doc_id", F.lit(False).alias("val")).unionByName(val.select("doc_id", F.lit(True).alias("val")))


@query("l4_shuffled", f"SELECT doc_id, {SHUFFLED} AS ordinal FROM documents")
def shuffled(spark, d):
    return L.shuffled(table(spark, d, "documents").select("doc_id"), "doc_id")


@query("l5_length_groups", f"WITH s AS (SELECT doc_id, n_chars, {SHUFFLED} AS i FROM documents) SELECT doc_id, i // 100 * 100 + row_number() OVER (PARTITION BY i // 100 ORDER BY n_chars DESC, i) - 1 AS position FROM s")
def length_groups(spark, d):
    return L.length_groups(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 2).select("doc_id", F.col("position").cast("long").alias("position"))


@query("l6_batches", "SELECT doc_id, i // 32 AS batch FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents) WHERE i // 32 < n // 32")
def batches(spark, d):
    return L.batches(table(spark, d, "documents").select("doc_id"), "doc_id", 32, drop_last=True).select("doc_id", "batch")


@query("l7_resumed_batches", "SELECT doc_id, i // 32 AS batch FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents) WHERE i // 32 < n // 32 AND i // 32 >= 3")
def resumed_batches(spark, d):
    return G.whole_batches(table(spark, d, "documents").select("doc_id"), "doc_id", 32, done=3).select("doc_id", "batch")


@query("l8_dynamic_groups", "WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, coalesce(stddev_samp(l_quantity) OVER (PARTITION BY l_orderkey), 0) AS sd FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey FROM g WHERE sd > 0 ORDER BY l_orderkey, l_linenumber, l_partkey LIMIT 500")
def dynamic_groups(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return L.dynamic_groups(x, "l_orderkey", "l_quantity", 500, "l_orderkey", "l_linenumber", "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("l9_negatives")
def negatives(spark, d):
    docs = table(spark, d, "documents").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("own"))
    pool = table(spark, d, "documents").select(F.concat("lang", F.lit("-"), "source").alias("v"))
    return L.negatives(docs, pool, "source", "own", "v", 3)


@query("l10_hard_negatives", """WITH g AS (SELECT c_nationkey, list(c_custkey ORDER BY c_acctbal DESC, c_custkey) AS p FROM customer GROUP BY 1),
f AS (SELECT *, len(p) - 2 AS n FROM g WHERE len(p) > 2),
r AS (SELECT *, list_transform(range(n, 12), lambda i: p[CAST('0x' || substr(md5('42:' || c_nationkey || ':' || i), 1, 8) AS BIGINT) % n + 2]) AS more FROM f)
SELECT c_nationkey, array_to_string(CASE WHEN n >= 12 THEN p[1:14] ELSE list_concat(p, more) END, ',') AS parts FROM r""")
def hard_negatives(spark, d):
    g = table(spark, d, "customer").groupBy("c_nationkey").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("c_acctbal")).alias("b"), "c_custkey"))), lambda x: x["c_custkey"]).alias("p")).where(F.size("p") > 2)
    return g.select("c_nationkey", F.array_join(L.hard_negatives(F.col("p"), "c_nationkey", 12), ",").alias("parts"))


@query("l11_quantile_filter", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_extendedprice >= (SELECT quantile_cont(l_extendedprice, 0.8) FROM lineitem)")
def quantile_filter(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    t = A.quantile_threshold(x, "l_extendedprice", 0.8)
    return x.join(F.broadcast(t)).where(F.col("l_extendedprice") >= F.col("t")).select("l_orderkey", "l_linenumber")


@query("l12_top_values", "SELECT vec_id, round(CAST(list_sort(embedding, 'DESC')[3] AS DOUBLE), 6) AS third FROM embeddings")
def top_values(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.round(F.element_at(M.top_k(F.col("embedding"), 3), 3).cast("double"), 6).alias("third"))


@query("u1_union", "SELECT doc_id AS id, lang AS a, NULL AS b FROM documents UNION ALL SELECT page_id, NULL, url FROM pages")
def union(spark, d):
    return L.concat([table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("a")), table(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("b"))])


INTERLEAVE = """WITH n AS (SELECT (SELECT count(*) FROM documents) AS a, (SELECT count(*) FROM pages) AS b),
s AS (SELECT i AS slot, CASE WHEN CAST('0x' || substr(md5('42:' || CAST(i AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.75 THEN 0 ELSE 1 END AS source FROM range(10000000) t(i) WHERE i < (SELECT 4 * (a + b) + 1000 FROM n)),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS nth FROM s),
z AS (SELECT min(slot) AS z FROM k, n WHERE nth = CASE source WHEN 0 THEN a ELSE b END),
r AS (SELECT 0 AS source, doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS nth FROM documents UNION ALL SELECT 1, page_id, row_number() OVER (ORDER BY page_id) - 1 FROM pages)
SELECT k.slot, k.source, r.id FROM k JOIN z ON k.slot < z.z JOIN r ON k.source = r.source AND k.nth = r.nth"""


@query("u2_interleaved", INTERLEAVE)
def interleaved(spark, d):
    a = table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    b = table(spark, d, "pages").select(F.col("page_id").alias("id"))
    return L.interleave([a, b], [3.0, 1.0], "id").select("slot", "source", "id")


@query("u2_interleaved_to_the_last", INTERLEAVE.replace("z AS (SELECT min(slot) AS z FROM k, n WHERE nth = CASE source WHEN 0 THEN a ELSE b END)", "z AS (SELECT max(slot) + 1 AS z FROM k, n WHERE nth = CASE source WHEN 0 THEN a ELSE b END - 1)").replace("k.nth = r.nth", "k.nth % CASE k.source WHEN 0 THEN n.a ELSE n.b END = r.nth").replace("FROM k JOIN z", "FROM n, k JOIN z"))
def interleaved_to_the_last(spark, d):
    a = table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    b = table(spark, d, "pages").select(F.col("page_id").alias("id"))
    return L.interleave([a, b], [3.0, 1.0], "id", stop="all_exhausted").select("slot", "source", "id")


@query("u5_multiset_overlap", """WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS a, string_split(lead(text) OVER (PARTITION BY conv_id ORDER BY turn, role, text), ' ') AS b FROM conversations)
SELECT conv_id, turn, CAST(coalesce(list_sum(list_transform(list_distinct(list_intersect(a, b)), lambda v: least(len(list_filter(a, lambda x: x = v)), len(list_filter(b, lambda x: x = v))))), 0) AS INTEGER) AS n FROM w WHERE b IS NOT NULL""")
def multiset_overlap(spark, d):
    from quarry.functions.text import word_counts_overlap

    rows = table(spark, d, "conversations").withColumn("next", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))).where("next IS NOT NULL")
    return rows.select("conv_id", "turn", word_counts_overlap(F.split("text", " "), F.split("next", " ")).alias("n"))


# Joins.


@query("j1_last_annotation", "SELECT c_custkey, c_name, arg_max(event_type, event_id) AS event_type FROM customer JOIN events ON c_custkey = user_id GROUP BY ALL")
def last_annotation(spark, d):
    ev = table(spark, d, "events").select(F.col("user_id").alias("c_custkey"), "event_id", "event_type")
    return J.lookup_last(table(spark, d, "customer").select("c_custkey", "c_name"), ev, "c_custkey", "event_id")


@query("j2_cache_misses", "SELECT doc_id FROM documents WHERE doc_id % 3 <> 0")
def cache_misses(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    cache = docs.where("doc_id % 3 <> 1").select(J.row_digest(docs).alias("digest"), F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))).alias("choices"))
    return J.cache_misses(docs, cache, 2).select("doc_id")


@query("j3_routed", "SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def routed(spark, d):
    return J.route(table(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey"), table(spark, d, "region"), "r_regionkey").select("n_nationkey", "r_name")


@query("j4_zipped", "WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i FROM documents), b AS (SELECT page_id, row_number() OVER (ORDER BY page_id) AS i FROM pages) SELECT doc_id, page_id FROM a JOIN b USING (i)")
def zipped(spark, d):
    b = table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), "page_id")
    return J.zipped(table(spark, d, "documents").select("doc_id"), b, "doc_id")


@query("j5_back_mapped", "WITH l AS (SELECT user_id, max(event_id) AS e FROM events GROUP BY 1), v AS (SELECT user_id, value FROM l JOIN events USING (user_id) WHERE event_id = e) SELECT event_id, round(v.value, 6) AS last_value FROM events JOIN v USING (user_id)")
def back_mapped(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "value")
    last = ev.groupBy("user_id").agg(F.max_by("value", "event_id").alias("last_value"))
    return ev.join(last, "user_id").select("event_id", F.round("last_value", 6).alias("last_value"))


@query("j6_listed_files", "SELECT page_id FROM pages WHERE page_id % 2 = 0 OR url IN (SELECT url FROM pages WHERE page_id % 2 = 0)")
def listed_files(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url")
    return J.existing(pages, pages.where("page_id % 2 = 0").select(F.col("url").alias("path")), "url").select("page_id")


@query("j8_similarity_blocks", """SELECT a.vec_id AS query_id, b.vec_id AS vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.label = b.label WHERE a.vec_id % 50 = 0""")
def similarity_blocks(spark, d):
    e = table(spark, d, "embeddings")
    q = e.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return J.similarity_blocks(q, e, "query_id", "vec_id", "embedding", "label").select("query_id", "vec_id", F.round("similarity", 6).alias("similarity"))


@query("j9_assigned_boxes")
def assigned_boxes(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    box = lambda i: F.slice("e", i, 4)
    return e.select("vec_id", A.multi_box_iou(F.array(box(1), box(5), box(9)), F.array(box(2), box(6))).alias("iou")).select("vec_id", F.array_join(F.transform("iou", lambda v: F.round(v, 6).cast("string")), ",").alias("iou"))


# Packing.

NEXT_FIT = """WITH RECURSIVE r AS (SELECT doc_id, n_chars AS n, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
p AS (SELECT i, doc_id, n, CAST(n AS BIGINT) AS size, CAST(0 AS BIGINT) AS pack FROM r WHERE i = 1
UNION ALL SELECT r.i, r.doc_id, r.n, CASE WHEN p.size >= 4096 OR p.size + r.n > 4096 THEN r.n ELSE p.size + r.n END, CASE WHEN p.size >= 4096 OR p.size + r.n > 4096 THEN p.pack + 1 ELSE p.pack END FROM p JOIN r ON r.i = p.i + 1)
SELECT CAST(pack AS INTEGER) AS pack_id, CAST(sum(n) AS BIGINT) AS length, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY i) AS rows FROM p GROUP BY pack"""


@query("k2_next_fit_packs", NEXT_FIT)
def next_fit_packs(spark, d):
    df = table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("n"))
    return K.pack(df, "doc_id", "n", 4096, "next_fit").select("pack_id", "length", F.array_join(F.transform("row_ids", lambda x: x.cast("string")), ",").alias("rows"))


@query("k1_best_fit_packs", "SELECT doc_id, true AS fits FROM documents")
def best_fit_packs(spark, d):
    packs = K.pack(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 4096, "best_fit")
    return packs.select(F.explode("row_ids").alias("doc_id"), ((F.col("length") <= 4096) | (F.size("row_ids") == 1)).alias("fits"))


@query("k3_packed_positions", "WITH r AS (SELECT doc_id, CAST(doc_id % 5 + 1 AS INTEGER) AS n FROM documents) SELECT CAST(sum(n) AS BIGINT) AS tokens, CAST(sum(n * (n - 1) / 2) AS BIGINT) AS positions FROM r")
def packed_positions(spark, d):
    ids = F.array_repeat(F.lit(7), (F.col("doc_id") % 5 + 1).cast("int"))
    rows = table(spark, d, "documents").select("doc_id", ids.alias("input_ids"), ids.alias("labels")).withColumn("n", F.size("input_ids"))
    out = K.packed_rows(K.pack(rows, "doc_id", "n", 64), rows, "doc_id")
    return out.agg(F.sum(F.size("input_ids")).alias("tokens"), F.sum(F.aggregate("position_ids", F.lit(0), lambda a, v: a + v)).alias("positions"))


# Metrics.


@query("a1_mean_metric", "SELECT l_returnflag, round(coalesce(avg(l_discount), 0), 6) AS m FROM lineitem GROUP BY 1")
def mean_metric(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(A.mean_metric(F.col("l_discount")), 6).alias("m"))


@query("a2_infer_stats", "WITH l AS (SELECT user_id, max(event_id) AS e FROM events GROUP BY 1), r AS (SELECT events.user_id, event_id FROM events JOIN l ON e = event_id) SELECT CAST(sum(user_id) AS BIGINT) AS prompt_tokens, CAST(sum(event_id) AS BIGINT) AS generated_tokens, count(*) AS samples, count(*) / 10.0::DOUBLE AS samples_per_s, CAST(sum(event_id) AS DOUBLE) / 10 AS tokens_per_s FROM r")
def infer_stats(spark, d):
    return A.infer_stats(table(spark, d, "events"), "user_id", "event_id", "user_id", "event_id", 10.0)


@query("a3_length_stats", "SELECT lang, round(avg(n_chars), 6) AS mean, round(stddev_pop(n_chars), 6) AS std, min(n_chars) AS min, max(n_chars) AS max, count(n_chars) AS size FROM documents GROUP BY 1")
def length_stats(spark, d):
    return A.length_stats(table(spark, d, "documents"), "n_chars", "lang").withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


def _labelled(spark, d) -> DataFrame:
    row = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", F.xxhash64("l_partkey").alias("h")))).alias("t"))
    return row.select("l_orderkey", F.transform("t", lambda x: F.when(x["l_linenumber"] % 3 == 0, F.lit(-100)).otherwise((x["l_partkey"] % 4).cast("int"))).alias("labels"), F.transform("t", lambda x: (x["l_suppkey"] % 4).cast("int")).alias("preds"))


ACC = """WITH t AS (SELECT l_orderkey, list(CASE WHEN l_linenumber % 3 = 0 THEN -100 ELSE l_partkey % 4 END ORDER BY l_linenumber, l_partkey, l_suppkey) AS l, list(l_suppkey % 4 ORDER BY l_linenumber, l_partkey, l_suppkey) AS p FROM lineitem GROUP BY 1),
z AS (SELECT l_orderkey, unnest(range(2, len(l) + 1)) AS i, l, p FROM t), h AS (SELECT l_orderkey, l[i] AS y, p[i - 1] AS q FROM z)"""


@query("a4_token_accuracy", ACC + " SELECT round(avg(CASE WHEN y = q THEN 1 ELSE 0 END), 6) AS token_acc FROM h WHERE y <> -100")
def token_accuracy(spark, d):
    return A.token_accuracy(_labelled(spark, d), "labels", "preds").select(F.round("token_acc", 6).alias("token_acc"))


@query("a4_sequence_accuracy", ACC + ", s AS (SELECT t.l_orderkey, coalesce(bool_and(y = q) FILTER (y <> -100), true) AS ok FROM t LEFT JOIN h USING (l_orderkey) GROUP BY 1) SELECT round(avg(CASE WHEN ok THEN 1 ELSE 0 END), 6) AS seq_acc FROM s")
def sequence_accuracy(spark, d):
    return A.sequence_accuracy(_labelled(spark, d), "labels", "preds").select(F.round("seq_acc", 6).alias("seq_acc"))


@query("a5_exact_match", "SELECT round(avg(CASE WHEN quality = toxic THEN 1 ELSE 0 END), 6) AS acc FROM labels")
def exact_match(spark, d):
    return table(spark, d, "labels").agg(F.round(A.exact_match(F.col("quality"), F.col("toxic")), 6).alias("acc"))


@query("a6_overlap_scores")
def overlap_scores(spark, d):
    rows = table(spark, d, "conversations").withColumn("next", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))).where("next IS NOT NULL")
    return A.overlap_scores(rows, "next", "text")


@query("a7_paired_correlations", """WITH v AS (SELECT label, vec_id, CAST(embedding[:32] AS DOUBLE[]) AS a, CAST(embedding[33:] AS DOUBLE[]) AS b FROM embeddings),
s AS (SELECT vec_id, CAST(label AS DOUBLE) AS y, unnest([{'measure': 'cosine', 's': list_cosine_similarity(a, b)}, {'measure': 'dot', 's': list_inner_product(a, b)}, {'measure': 'euclidean', 's': -list_distance(a, b)}, {'measure': 'manhattan', 's': -list_sum(list_transform(range(1, 33), lambda i: abs(a[i] - b[i])))}]) AS m FROM v),
t AS (SELECT y, m.measure AS measure, m.s AS s FROM s),
r AS (SELECT *, rank() OVER (PARTITION BY measure ORDER BY s) + (count(*) OVER (PARTITION BY measure, s) - 1) / 2 AS rs, rank() OVER (PARTITION BY measure ORDER BY y) + (count(*) OVER (PARTITION BY measure, y) - 1) / 2 AS ry FROM t)
SELECT measure, round(corr(s, y), 6) AS pearson, round(corr(rs, ry), 6) AS spearman FROM r GROUP BY 1""")
def paired_correlations(spark, d):
    e = table(spark, d, "embeddings").select("label", F.slice("embedding", 1, 32).alias("a"), F.slice("embedding", 33, 32).alias("b"))
    return A.paired_correlations(e, "a", "b", "label").withColumns({"pearson": F.round("pearson", 6), "spearman": F.round("spearman", 6)})


@query("a8_in_batch_margins", """WITH u AS (SELECT label AS b, vec_id, list_transform(CAST(embedding[:32] AS DOUBLE[]), lambda x: x / sqrt(list_inner_product(CAST(embedding[:32] AS DOUBLE[]), CAST(embedding[:32] AS DOUBLE[])))) AS a, list_transform(CAST(embedding[33:] AS DOUBLE[]), lambda x: x / sqrt(list_inner_product(CAST(embedding[33:] AS DOUBLE[]), CAST(embedding[33:] AS DOUBLE[])))) AS p FROM embeddings),
o AS (SELECT avg(list_inner_product(a, p)) AS mp FROM u), n AS (SELECT x.vec_id, avg(list_inner_product(x.a, y.p)) AS neg FROM u x JOIN u y ON x.b = y.b AND x.vec_id <> y.vec_id GROUP BY 1)
SELECT round(mp, 6) AS mean_pos, round(avg(neg), 6) AS mean_neg, round(mp - avg(neg), 6) AS margin FROM n, o GROUP BY mp""")
def in_batch_margins(spark, d):
    e = table(spark, d, "embeddings").select(F.col("label").alias("b"), "vec_id", *[F.transform(F.slice("embedding", i, 32), lambda v: v.cast("double")).alias(n) for n, i in (("a", 1), ("p", 33))])
    out = A.in_batch_margins(e, "b", "vec_id", "a", "p")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


RANKING = """WITH x AS (SELECT user_id, event_id, value, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y FROM events),
g AS (SELECT *, sum(y) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS grp FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, grp ORDER BY value DESC, event_id) AS rk FROM g WHERE grp > 0),
p AS (SELECT user_id, grp, count(*) AS n, min(rk) FILTER (y = 1) AS f, sum(y / log2(rk + 1)) AS dcg FROM r GROUP BY 1, 2 HAVING count(*) >= 2)"""


@query("a9_reranker_metrics", RANKING + " SELECT round(avg(1 / f), 6) AS mrr, round(avg(dcg), 6) AS ndcg FROM p")
def reranker_metrics(spark, d):
    e = table(spark, d, "events").withColumn("y", (F.col("event_type") == "purchase").cast("int"))
    out = A.reranker_metrics(e, "event_id", "value", "y", "user_id")
    return out.select(F.round("mrr", 6).alias("mrr"), F.round("ndcg", 6).alias("ndcg"))


@query("a10_reward_metrics", "WITH g AS (SELECT l_orderkey, avg(l_discount) AS m, coalesce(stddev_samp(l_discount), 0) AS sd FROM lineitem GROUP BY 1) SELECT round(avg(m), 6) AS reward, round(avg(sd), 6) AS group_std, round(avg(CASE WHEN sd <= 1e-8 THEN 1 ELSE 0 END), 6) AS frac_zero_std, round((SELECT stddev_samp(l_discount) FROM lineitem), 6) AS batch_std FROM g")
def reward_metrics(spark, d):
    out = R.reward_metrics(table(spark, d, "lineitem"), "l_orderkey", "l_discount")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("a12_conditional_means", "SELECT lang, round(coalesce(avg(CASE WHEN source = 'src0' THEN n_chars END), 0), 6) AS first_source FROM documents GROUP BY 1")
def conditional_means(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.round(A.conditional_mean(F.col("n_chars").cast("double"), F.col("source") == "src0"), 6).alias("first_source"))


@query("a13_grouped_accuracy", "SELECT coalesce(lang, 'unknown') AS grp, round(avg(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END), 6) AS accuracy, round(avg(CASE WHEN n_chars > 10 THEN 1 ELSE 0 END), 6) AS parse_rate, count(*) AS n FROM documents GROUP BY 1 UNION ALL SELECT NULL, round(avg(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END), 6), round(avg(CASE WHEN n_chars > 10 THEN 1 ELSE 0 END), 6), count(*) FROM documents")
def grouped_accuracy(spark, d):
    out = A.grouped_accuracy(table(spark, d, "documents"), F.col("n_chars") > 1000, F.col("n_chars") > 10, "lang")
    return out.withColumns({"accuracy": F.round("accuracy", 6), "parse_rate": F.round("parse_rate", 6)})


BOX = "WITH b AS (SELECT vec_id, list_transform([embedding[1], embedding[2], embedding[3], embedding[4]], lambda x: CAST(x AS DOUBLE)) AS p, list_transform([embedding[2], embedding[3], embedding[4], embedding[5]], lambda x: CAST(x AS DOUBLE)) AS q FROM embeddings), s AS (SELECT vec_id, least(p[1],p[3]) a1, least(p[2],p[4]) a2, greatest(p[1],p[3]) a3, greatest(p[2],p[4]) a4, least(q[1],q[3]) b1, least(q[2],q[4]) b2, greatest(q[1],q[3]) b3, greatest(q[2],q[4]) b4 FROM b), i AS (SELECT *, greatest(least(a3,b3)-greatest(a1,b1),0)*greatest(least(a4,b4)-greatest(a2,b2),0) AS x FROM s), u AS (SELECT vec_id, x, (a3-a1)*(a4-a2)+(b3-b1)*(b4-b2)-x AS u FROM i), r AS (SELECT vec_id, CASE WHEN u > 0 THEN x/u ELSE 0 END AS iou FROM u)"


def _boxes(spark, d) -> DataFrame:
    e = table(spark, d, "embeddings").withColumn("e", F.transform("embedding", lambda v: v.cast("double")))
    return e.select("vec_id", F.slice("e", 1, 4).alias("p"), F.slice("e", 2, 4).alias("q"))


@query("m1_box_iou", BOX + " SELECT vec_id, round(iou, 6) AS iou FROM r")
def box_iou(spark, d):
    return _boxes(spark, d).select("vec_id", F.round(M.box_iou(F.col("p"), F.col("q")), 6).alias("iou"))


@query("a14_grounding", BOX + " SELECT round(avg(iou), 6) AS mean_iou, round(avg(CASE WHEN iou >= 0.5 THEN 1 ELSE 0 END), 6) AS acc, count(*) AS n FROM r")
def grounding(spark, d):
    out = A.grounding(_boxes(spark, d), M.box_iou(F.col("p"), F.col("q")))
    return out.withColumns({"mean_iou": F.round("mean_iou", 6), "acc": F.round("acc", 6)})


@query("a16_first_per_prompt", "SELECT lang, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def first_per_prompt(spark, d):
    w = Window.partitionBy("lang").orderBy("doc_id")
    return table(spark, d, "documents").withColumn("r", F.row_number().over(w)).where("r = 1").select("lang", "doc_id")


@query("a18_sample_statistics", "SELECT l_returnflag, round(exp(avg(ln(l_quantity))), 6) AS geometric_mean, round(sum(l_quantity) * sum(l_quantity) / sum(l_quantity * l_quantity), 4) AS ess FROM lineitem GROUP BY 1")
def sample_statistics(spark, d):
    g, e = A.sample_statistics(F.col("l_quantity"), F.col("l_quantity"))
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(g, 6).alias("geometric_mean"), F.round(e, 4).alias("ess"))


@query("m2_scaled_boxes", "SELECT o_orderkey, CAST(round_even(o_custkey / 640.0 * 1000, 0) AS INTEGER) AS x, CAST(round_even(o_custkey / 480.0 * 1000, 0) AS INTEGER) AS y FROM orders")
def scaled_boxes(spark, d):
    c = F.col("o_custkey").cast("double")
    x = table(spark, d, "orders").select("o_orderkey", M.scaled_box(F.array(c, c), F.lit(640.0), F.lit(480.0)).alias("b"))
    return x.select("o_orderkey", F.get("b", F.lit(0)).alias("x"), F.get("b", F.lit(1)).alias("y"))


@query("m4_min_max", "WITH w AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, min(l_quantity) OVER (PARTITION BY l_orderkey) AS a, max(l_quantity) OVER (PARTITION BY l_orderkey) AS b FROM lineitem) SELECT l_orderkey, l_linenumber, l_extendedprice, round(CASE WHEN b - a > 1e-5 THEN (l_quantity - a) / (b - a + 1e-5) WHEN l_quantity = 0 THEN 0 ELSE least(1, l_quantity) END, 6) AS n FROM w")
def min_max(spark, d):
    out = G.normalised(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"), "l_orderkey", "l_quantity", "n")
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice", F.round("n", 6).alias("n"))


@query("m6_distances", "WITH v AS (SELECT vec_id, CAST(embedding[:32] AS DOUBLE[]) AS a, CAST(embedding[33:] AS DOUBLE[]) AS b FROM embeddings) SELECT vec_id, round(list_cosine_similarity(a, b), 6) AS cosine, round(list_distance(a, b), 6) AS l2, round(list_sum(list_transform(range(1, 33), lambda i: abs(a[i] - b[i]))), 6) AS l1, round(list_inner_product(a, b), 6) AS dot FROM v")
def distances(spark, d):
    a, b = F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)
    return table(spark, d, "embeddings").select("vec_id", F.round(M.cosine(a, b), 6).alias("cosine"), F.round(M.euclidean(a, b), 6).alias("l2"), F.round(M.manhattan(a, b), 6).alias("l1"), F.round(M.dot(a, b), 6).alias("dot"))


@query("m8_log_sum_exp", "SELECT vec_id, round(ln(list_sum(list_transform(embedding, lambda x: exp(CAST(x AS DOUBLE))))), 6) AS v FROM embeddings")
def log_sum_exp(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.round(M.log_sum_exp(F.transform("embedding", lambda v: v.cast("double"))), 6).alias("v"))


@query("m9_sublists", "SELECT doc_id, array_to_string(list_filter(range(0, length(source) + 1 - 1), lambda i: substr(source, CAST(i AS BIGINT) + 1, 1) = '1'), ',') AS at FROM documents")
def sublists(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(M.sublist_positions(F.split("source", ""), F.array(F.lit("1"))), ",").alias("at"))


@query("m10_first_given", "SELECT doc_id, coalesce(nullif(lang, ''), nullif(CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END, ''), 'z') AS s, CASE WHEN doc_id % 3 <> 0 THEN doc_id % 3 WHEN doc_id % 5 <> 0 THEN doc_id % 5 ELSE -1 END AS n FROM documents")
def first_given(spark, d):
    texts = F.array("lang", F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise(""), F.lit("z"))
    return table(spark, d, "documents").select("doc_id", M.first_given(texts, F.lit("")).alias("s"), F.coalesce(M.first_given(F.array(F.col("doc_id") % 3, F.col("doc_id") % 5), F.lit(0)), F.lit(-1)).alias("n"))


@query("m14_nan_statistics", """WITH g AS (SELECT l_orderkey, list(CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity END) AS q FROM lineitem GROUP BY 1), u AS (SELECT l_orderkey, unnest(q) AS x FROM g)
SELECT l_orderkey, round(coalesce(avg(x), -1), 6) AS mean, round(coalesce(stddev_samp(x), -1), 6) AS std, round(coalesce(sum(x), 0), 6) AS total FROM u GROUP BY 1""")
def nan_statistics(spark, d):
    x = F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")).otherwise(float("nan"))
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(x).alias("q"))
    return g.select("l_orderkey", *[F.round(F.nanvl(f(F.col("q")), F.lit(-1.0)), 6).alias(n) for n, f in (("mean", M.nan_mean), ("std", M.nan_std), ("total", M.nan_total))])


# Windows.


@query("w8_discounted_future", "SELECT vec_id, round(CAST(embedding[1] AS DOUBLE) + 0.5 * CAST(embedding[2] AS DOUBLE) + 0.25 * CAST(embedding[3] AS DOUBLE), 6) AS v FROM embeddings")
def discounted(spark, d):
    x = M.discounted_future(F.transform(F.slice("embedding", 1, 3), lambda v: v.cast("double")), 0.5)
    return table(spark, d, "embeddings").select("vec_id", F.round(F.get(x, F.lit(0)), 6).alias("v"))


@query("w9_position_ids", "WITH g AS (SELECT l_orderkey, list(l_linenumber % 4 ORDER BY l_linenumber, l_partkey) AS n FROM lineitem GROUP BY 1) SELECT l_orderkey, array_to_string(flatten(list_transform(n, lambda k: range(k))), ',') AS ids FROM g")
def position_ids(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: (x["l_linenumber"] % 4).cast("int")).alias("n"))
    return g.select("l_orderkey", F.array_join(M.position_ids(F.col("n")), ",").alias("ids"))


@query("w11_sessions", "WITH x AS (SELECT user_id, event_id, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS conv FROM events) SELECT user_id, CAST(conv AS BIGINT) AS conv, CAST(2 * count(*) AS INTEGER) AS turns FROM x WHERE conv > 0 GROUP BY ALL")
def sessions(spark, d):
    from quarry.operators.datasets import action_sessions

    e = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") == "view", "0").otherwise("1").alias("target_action_index"), F.lit("a -> CLICK: b").alias("action"), F.lit("task").alias("task"))
    return action_sessions(e, "event_id", "user_id").select("user_id", "conv", F.size("messages").alias("turns"))


# Preference numerics. Lines of an order are the rows of a group.


def _lines(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax")


KEYS = "l_orderkey, l_linenumber, l_partkey"
GROUPED = "w AS (SELECT *, avg(l_quantity) OVER (PARTITION BY l_orderkey) AS m, coalesce(stddev_samp(l_quantity) OVER (PARTITION BY l_orderkey), 0) AS sd, count(*) OVER (PARTITION BY l_orderkey) AS k FROM lineitem)"


def _rounded(df: DataFrame, name: str = "advantage", digits: int = 5) -> DataFrame:
    return df.select("l_orderkey", "l_linenumber", "l_partkey", (F.round(name, digits) + 0.0).alias(name))


@query("r3_grpo_advantage", f"WITH {GROUPED} SELECT {KEYS}, round((l_quantity - m) / (sd + 1e-4), 5) + 0.0 AS advantage FROM w")
def grpo_advantage(spark, d):
    return _rounded(R.advantages(_lines(spark, d), "l_orderkey", "l_quantity"))


@query("r3_rloo_advantage", f"WITH {GROUPED} SELECT {KEYS}, round(CASE WHEN k > 1 THEN (l_quantity - m) * k / (k - 1) ELSE 0 END, 5) + 0.0 AS advantage FROM w")
def rloo_advantage(spark, d):
    return _rounded(R.advantages(_lines(spark, d), "l_orderkey", "l_quantity", "rloo", "none"))


@query("r4_batch_scaled", f"WITH {GROUPED} SELECT {KEYS}, round((l_quantity - m) / ((SELECT stddev_samp(l_quantity) FROM lineitem) + 1e-4), 5) + 0.0 AS advantage FROM w")
def batch_scaled(spark, d):
    return _rounded(R.advantages(_lines(spark, d), "l_orderkey", "l_quantity", scale="batch"))


@query("r5_per_function", """WITH z AS (SELECT l_orderkey, l_linenumber, l_partkey, coalesce((l_quantity - avg(l_quantity) OVER p) / (coalesce(stddev_samp(l_quantity) OVER p, 0) + 1e-8), 0) + 0.5 * coalesce((l_discount - avg(l_discount) OVER p) / (coalesce(stddev_samp(l_discount) OVER p, 0) + 1e-8), 0) AS a FROM lineitem WINDOW p AS (PARTITION BY l_orderkey))
SELECT l_orderkey, l_linenumber, l_partkey, round((a - (SELECT avg(a) FROM z)) / ((SELECT stddev_samp(a) FROM z) + 1e-8), 4) + 0.0 AS advantage FROM z""")
def per_function(spark, d):
    return _rounded(R.per_function_advantages(_lines(spark, d), "l_orderkey", {"l_quantity": 1.0, "l_discount": 0.5}), digits=4)


@query("r6_request_advantage", """WITH l AS (SELECT user_id, max(event_id) AS e FROM events GROUP BY 1), r AS (SELECT e.user_id, e.user_id % 10 AS grp, value FROM events e JOIN l ON e.event_id = l.e), a AS (SELECT user_id, (value - avg(value) OVER (PARTITION BY grp)) / (coalesce(stddev_samp(value) OVER (PARTITION BY grp), 0) + 1e-4) AS a FROM r)
SELECT event_id, round(a, 5) + 0.0 AS advantage FROM events JOIN a USING (user_id)""")
def request_advantage(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "value", (F.col("user_id") % 10).alias("grp"))
    return R.request_advantages(e, "grp", "user_id", "event_id", "value").select("event_id", (F.round("advantage", 5) + 0.0).alias("advantage"))


@query("r1_weighted_reward", "SELECT l_orderkey, l_linenumber, l_partkey, round(2 * l_quantity + CASE WHEN l_linenumber = 1 THEN 0 ELSE 0.5 * l_discount END - 0.1 * l_tax, 6) AS r FROM lineitem")
def weighted_reward(spark, d):
    r = R.weighted_reward([F.col("l_quantity"), F.when(F.col("l_linenumber") > 1, F.col("l_discount"))], [2.0, 0.5])
    return _lines(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", F.round(R.kl_reward(r, F.col("l_tax"), 0.1), 6).alias("r"))


def _tokens(spark, d) -> DataFrame:
    """Four tokens a line: two models' log probabilities and a mask."""
    g = lambda c, k: -F.col(c) * k
    return _lines(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_discount") - 0.05).alias("adv"), F.array(g("l_discount", 1.0), g("l_tax", 2.0), g("l_quantity", 0.02), F.lit(-1.0)).alias("a"), F.array(g("l_tax", 1.0), g("l_discount", 1.5), g("l_quantity", 0.01), F.lit(-0.5)).alias("b"), F.array(F.lit(1), F.lit(1), (F.col("l_linenumber") % 2).cast("int"), F.lit(0)).alias("mask"))


TOK = "t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_discount - 0.05 AS adv, -l_discount AS a1, -l_tax * 2 AS a2, -l_quantity * 0.02 AS a3, -l_tax AS b1, -l_discount * 1.5 AS b2, -l_quantity * 0.01 AS b3, l_linenumber % 2 AS m3 FROM lineitem)"
KEY3 = "l_orderkey, l_linenumber, l_partkey"


def _by_line(df: DataFrame, value, name: str) -> DataFrame:
    return df.select("l_orderkey", "l_linenumber", "l_partkey", (F.round(value, 6) + 0.0).alias(name))


@query("r8_k3", f"WITH {TOK} SELECT {KEY3}, round(exp(a1-b1)-(a1-b1)-1 + exp(a2-b2)-(a2-b2)-1 + CASE WHEN m3 = 1 THEN exp(a3-b3)-(a3-b3)-1 ELSE 0 END, 6) + 0.0 AS k3 FROM t")
def k3(spark, d):
    return _by_line(_tokens(spark, d), M.total(R.k3(F.col("a"), F.col("b"), F.col("mask"))), "k3")


@query("f10_kept_masks", "SELECT event_id, CASE WHEN event_type = 'view' THEN '0,0,0' ELSE '1,0,1' END AS mask FROM events")
def kept_masks(spark, d):
    reason = F.when(F.col("event_type") == "view", "length").when(F.col("event_type") == "purchase", "stop")
    return table(spark, d, "events").select("event_id", F.array_join(R.kept_mask(F.array(F.lit(1), F.lit(0), F.lit(1)), reason), ",").alias("mask"))


@query("r9_token_advantage", f"WITH {TOK} SELECT {KEY3}, round(adv + 0.3 * (a1 - b1), 6) + 0.0 AS first FROM t")
def token_advantage(spark, d):
    return _by_line(_tokens(spark, d), F.get(R.token_advantage(F.col("adv"), F.col("a"), F.col("b"), 0.3), F.lit(0)), "first")


@query("r10_reweighted", f"WITH {TOK} SELECT {KEY3}, round(adv * (0.5 + 0.5 * least(greatest(exp(sign(adv) * (a1 - b1)), 0.8), 1.2)), 6) + 0.0 AS first FROM t")
def reweighted(spark, d):
    delta = F.zip_with("a", "b", lambda x, y: x - y)
    return _by_line(_tokens(spark, d), F.get(R.reweighted(F.col("adv"), delta, 0.5, 0.2), F.lit(0)), "first")


@query("r11_gated_loss", f"WITH {TOK}, g AS (SELECT a1 / (1 + exp(-2 * (a1 - b1))) + a2 / (1 + exp(-2 * (a2 - b2))) + CASE WHEN m3 = 1 THEN a3 / (1 + exp(-2 * (a3 - b3))) ELSE 0 END AS s, 2 + m3 AS n FROM t) SELECT round(sum(s) / sum(n), 6) AS loss FROM g")
def gated_loss(spark, d):
    delta = F.zip_with("a", "b", lambda x, y: x - y)
    x = _tokens(spark, d).withColumn("l", R.gated(F.col("a"), delta, 2.0))
    return R.aggregate_loss(x, "l", "mask", "token-mean").select(F.round("loss", 6).alias("loss"))


@query("r12_policy_loss", f"WITH {TOK}, r AS (SELECT *, exp(a1-b1) AS r1, exp(a2-b2) AS r2, exp(a3-b3) AS r3 FROM t), l AS (SELECT (-least(r1*adv, least(greatest(r1,0.8),1.2)*adv) - least(r2*adv, least(greatest(r2,0.8),1.2)*adv) + CASE WHEN m3 = 1 THEN -least(r3*adv, least(greatest(r3,0.8),1.2)*adv) ELSE 0 END) AS s, 2 + m3 AS n FROM r) SELECT round(avg(s / n), 6) AS loss FROM l")
def policy_loss(spark, d):
    x = _tokens(spark, d)
    ratio = R.importance(F.col("a"), F.col("b"), F.col("mask"))
    x = x.withColumn("l", R.policy_loss(ratio, F.col("adv"), F.col("a")))
    return R.reduced_loss(x, "l", "mask", "grpo").select(F.round("loss", 6).alias("loss"))


@query("r12_contrast_loss", "WITH g AS (SELECT l_orderkey, sum(exp(-l_discount)) FILTER (l_tax > 0.04) AS p, sum(exp(l_discount)) FILTER (l_tax < 0.04) AS n FROM lineitem GROUP BY 1) SELECT l_orderkey, round(ln(1 + p) + ln(1 + n), 6) AS loss FROM g WHERE p IS NOT NULL AND n IS NOT NULL")
def contrast_loss(spark, d):
    x = _lines(spark, d).withColumn("adv", F.when(F.col("l_tax") > 0.04, 1).when(F.col("l_tax") < 0.04, -1).otherwise(0))
    return R.contrast_loss(x, "l_orderkey", "l_discount", "adv").withColumn("loss", F.round("loss", 6))


@query("r13_rollout_weights", f"WITH {TOK}, s AS (SELECT *, exp((a1-b1 + a2-b2 + CASE WHEN m3 = 1 THEN a3-b3 ELSE 0 END) / (2 + m3)) AS q FROM t) SELECT {KEY3}, round(least(exp(a1-b1), 1.05), 6) AS tt, round(CASE WHEN exp(a1-b1) <= 1.05 THEN exp(a1-b1) ELSE 0 END, 6) AS tm, round(least(q, 1.05), 6) AS st, round(CASE WHEN q <= 1.05 THEN q ELSE 0 END, 6) AS sm FROM s")
def rollout_weights(spark, d):
    w = lambda mode: F.round(F.get(R.rollout_weights(F.col("a"), F.col("b"), F.col("mask"), mode, 1.05), F.lit(0)), 6)
    return _tokens(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", w("token_truncate").alias("tt"), w("token_mask").alias("tm"), w("sequence_truncate").alias("st"), w("sequence_mask").alias("sm"))


@query("r14_off_policy_kept", f"WITH {TOK} SELECT {KEY3}, NOT ((b1-a1 + b2-a2 + CASE WHEN m3 = 1 THEN b3-a3 ELSE 0 END) / (2 + m3) > 0.0213 AND adv < 0) AS kept FROM t")
def off_policy_kept(spark, d):
    x = _tokens(spark, d)
    return x.select("l_orderkey", "l_linenumber", "l_partkey", R.off_policy_kept(F.col("b"), F.col("a"), F.col("mask"), F.col("adv"), 0.0213).alias("kept"))


@query("r15_off_policy_metrics", f"WITH {TOK}, s AS (SELECT 2 + m3 AS n, a1-b1 + a2-b2 + CASE WHEN m3 = 1 THEN a3-b3 ELSE 0 END AS d, exp(a1-b1)-(a1-b1)-1 + exp(a2-b2)-(a2-b2)-1 + CASE WHEN m3 = 1 THEN exp(a3-b3)-(a3-b3)-1 ELSE 0 END AS k, (b1 + b2 + CASE WHEN m3 = 1 THEN b3 ELSE 0 END) / (2 + m3) - (a1 + a2 + CASE WHEN m3 = 1 THEN a3 ELSE 0 END) / (2 + m3) AS f FROM t) SELECT round(-sum(d) / sum(n), 6) AS kl, round(sum(k) / sum(n), 6) AS k3_kl, round(avg(f), 6) AS log_ppl_diff, round(max(f), 6) AS log_ppl_diff_max, round(avg(exp(f)), 6) AS ppl_ratio FROM s")
def off_policy_metrics(spark, d):
    out = R.off_policy_metrics(_tokens(spark, d), "a", "b", "mask")
    return out.select(*[F.round(c, 6).alias(c) for c in ("kl", "k3_kl", "log_ppl_diff", "log_ppl_diff_max", "ppl_ratio")])


@query("r16_weight_metrics", f"WITH {TOK}, w AS (SELECT exp(a1-b1) AS w FROM t UNION ALL SELECT exp(a2-b2) FROM t UNION ALL SELECT exp(a3-b3) FROM t WHERE m3 = 1) SELECT round(avg(w), 6) AS weight_mean, round(sum(w) * sum(w) / sum(w * w) / count(*), 6) AS ess, round(avg(CASE WHEN w > 1.05 THEN 1 ELSE 0 END), 6) AS clipped_frac FROM w")
def weight_metrics(spark, d):
    x = _tokens(spark, d).withColumn("w", R.importance(F.col("a"), F.col("b"), F.col("mask")))
    out = R.weight_metrics(x, "w", "mask", 1.05)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


SIG = "(1 / (1 + exp(-({0}))))"
LS = "ln(1 / (1 + exp(-({0}))))"
PAIRS = "p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_discount * 10 AS c, l_tax * 10 AS r FROM lineitem)"
LOSSES = {
    "sigmoid": f"-0.9 * {LS.format('0.1*(c-r)')} - 0.1 * {LS.format('-0.1*(c-r)')}",
    "robust": f"(-0.9 * {LS.format('0.1*(c-r)')} + 0.1 * {LS.format('-0.1*(c-r)')}) / 0.8",
    "exo_pair": f"{SIG.format('0.1*(c-r)')} * ({LS.format('0.1*(c-r)')} - ln(0.9)) + {SIG.format('-0.1*(c-r)')} * ({LS.format('-0.1*(c-r)')} - ln(0.1))",
    "hinge": "greatest(0, 1 - 0.1*(c-r))", "ipo": "pow(c - r - 5, 2)",
    "bco_pair": f"-{LS.format('0.1*c - 0.2')} - {LS.format('-(0.1*r - 0.2)')}", "sppo_hard": "pow(c - 5, 2) + pow(r + 5, 2)",
    "nca_pair": f"-{LS.format('0.1*c')} - 0.5 * {LS.format('-0.1*c')} - 0.5 * {LS.format('-0.1*r')}",
    "apo_zero": f"1 - {SIG.format('0.1*c')} + {SIG.format('0.1*r')}", "apo_down": f"{SIG.format('0.1*c')} + 1 - {SIG.format('0.1*(c-r)')}",
    "discopop": f"-{LS.format('0.1*(c-r)')} * (1 - {SIG.format('2*(c-r)')}) + exp(-0.1*(c-r)) * {SIG.format('2*(c-r)')}",
}


@query("r17_preference_losses", f"WITH {PAIRS} SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(f"round({e}, 6) + 0.0 AS {k}" for k, e in LOSSES.items()) + " FROM p")
def preference_losses(spark, d):
    c, r = F.col("l_discount") * 10, F.col("l_tax") * 10
    return _lines(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", *[(F.round(R.preference_loss(c, r, k, 0.1, 0.1, 0.2), 6) + 0.0).alias(k) for k in LOSSES])


@query("r17_ranked_pairs", f"WITH {PAIRS}, i AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) AS i FROM p), a AS (SELECT l_orderkey, c, row_number() OVER (PARTITION BY l_orderkey ORDER BY c, i) AS rank FROM i), b AS (SELECT l_orderkey, r, row_number() OVER (PARTITION BY l_orderkey ORDER BY r, i) AS rank FROM i) SELECT l_orderkey, CAST(rank AS INTEGER) AS rank, round(-{LS.format('0.1*(c-r)')}, 6) AS loss FROM a JOIN b USING (l_orderkey, rank)")
def ranked_pairs(spark, d):
    x = _lines(spark, d).select("l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("c"), (F.col("l_tax") * 10).alias("r"))
    return R.ranked_pairs(x, "l_orderkey", "l_linenumber", "c", "r").withColumn("loss", F.round("loss", 6))


@query("r18_other_losses", f"""WITH q AS (SELECT l_orderkey, l_linenumber, l_partkey, -l_discount - 0.1 AS c, -l_tax - 0.2 AS r FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, round(-{LS.format('2*(c-r)-1')}, 6) AS simpo, round(-{LS.format('0.1*(c-r)')} + 0.3, 6) AS cpo, round(0.3 - 0.1 * {LS.format('(c-r) - (ln(1-exp(c)) - ln(1-exp(r)))')}, 6) AS orpo, round(-{LS.format('c-r-0.1')}, 6) AS rm, round(CASE WHEN l_linenumber = 1 THEN 1 - {SIG.format('0.1*(c-r-0.05)')} ELSE 1 - {SIG.format('0.1*(0.05-(c-r))')} END, 6) AS kto FROM q""")
def other_losses(spark, d):
    c, r = -F.col("l_discount") - 0.1, -F.col("l_tax") - 0.2
    v = {"simpo": R.simpo_loss(c, r), "cpo": R.cpo_loss(c, r, F.lit(0.3)), "orpo": R.orpo_loss(c, r, F.lit(0.3)), "rm": R.reward_model_loss(c, r, F.lit(0.1)), "kto": R.kto_loss(c, r, F.col("l_linenumber") == 1, F.lit(0.05))}
    return _lines(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", *[F.round(x, 6).alias(k) for k, x in v.items()])


@query("r19_jsd", """WITH q AS (SELECT l_orderkey, l_linenumber, l_partkey, 0.2 + l_discount AS p, 0.5 + l_tax AS s FROM lineitem), m AS (SELECT *, 0.5 * p + 0.5 * s AS h FROM q)
SELECT l_orderkey, l_linenumber, l_partkey, round(0.5 * (p * ln(p / h) + (1-p) * ln((1-p) / (1-h))) + 0.5 * (s * ln(s / h) + (1-s) * ln((1-s) / (1-h))), 6) AS jsd FROM m""")
def jsd(spark, d):
    dist = lambda p: F.array(F.log(p), F.log(1 - p))
    return _by_line(_lines(spark, d), R.jsd(dist(0.2 + F.col("l_discount")), dist(0.5 + F.col("l_tax"))), "jsd")


@query("r20_embedding_losses", "WITH v AS (SELECT vec_id, label % 2 AS y, 1 - list_cosine_similarity(CAST(embedding[:32] AS DOUBLE[]), CAST(embedding[33:] AS DOUBLE[])) AS dist, list_transform(embedding[:4], lambda x: CAST(x AS DOUBLE) / 0.5) AS s FROM embeddings) SELECT vec_id, round(0.5 * (y * dist * dist + (1 - y) * pow(greatest(0.5 - dist, 0), 2)), 6) AS contrastive, round(ln(list_sum(list_transform(s, lambda x: exp(x)))) - s[1], 6) AS infonce FROM v")
def embedding_losses(spark, d):
    dist = 1 - M.cosine(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32))
    s = F.transform(F.slice("embedding", 1, 4), lambda v: v.cast("double"))
    return table(spark, d, "embeddings").select("vec_id", F.round(R.contrastive_loss(dist, F.col("label") % 2), 6).alias("contrastive"), F.round(R.infonce(s, 0.5), 6).alias("infonce"))


@query("r21_listwise_loss", RANKING.rsplit(",\nr AS", 1)[0] + ", l AS (SELECT user_id, grp, count(*) AS n, sum(exp(value / 100)) AS z, max(value) FILTER (y = 1) AS p FROM g WHERE grp > 0 GROUP BY 1, 2) SELECT user_id, CAST(grp AS BIGINT) AS grp, round(ln(z) - p / 100, 6) + 0.0 AS loss FROM l WHERE n >= 2")
def listwise_loss(spark, d):
    e = table(spark, d, "events").withColumn("y", (F.col("event_type") == "purchase").cast("int"))
    return R.listwise_loss(e, "event_id", "value", "y", 100.0, "user_id").withColumn("loss", F.round("loss", 6) + 0.0)


@query("r21_pointwise_loss", "SELECT vec_id, round(greatest(CAST(embedding[1] AS DOUBLE), 0) - CAST(embedding[1] AS DOUBLE) * (label % 2) + ln(1 + exp(-abs(CAST(embedding[1] AS DOUBLE)))), 6) AS loss FROM embeddings")
def pointwise_loss(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.round(R.pointwise_loss(F.get("embedding", F.lit(0)).cast("double"), F.col("label") % 2), 6).alias("loss"))


@query("r22_reward_matrix", "SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN l_linenumber = 1 THEN 0 ELSE l_quantity + 2 * coalesce(CASE WHEN l_linenumber > 2 THEN l_discount END, 0) END, 6) AS reward, l_linenumber = 1 AS no_reward FROM lineitem")
def reward_matrix(spark, d):
    from quarry.operators.rewards import reward_matrix as matrix

    x = matrix(_lines(spark, d), {"a": F.when(F.col("l_linenumber") > 1, F.col("l_quantity")), "b": F.when(F.col("l_linenumber") > 2, F.col("l_discount"))}, {"b": 2.0})
    return x.select("l_orderkey", "l_linenumber", "l_partkey", F.round("reward", 6).alias("reward"), "no_reward")


# Rejection sampling.


@query("g1_replicated", "SELECT n_nationkey, CAST(k AS INTEGER) AS nth FROM nation, range(4) t(k)")
def replicated(spark, d):
    return G.replicated(table(spark, d, "nation").select("n_nationkey"), 4)


@query("g3_selected", """WITH x AS (SELECT l_orderkey, lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || '-' || CAST(l_partkey AS VARCHAR) AS c, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS o, l_discount AS p FROM lineitem),
s AS (SELECT *, p + 10 * o AS sc, first_value(c) OVER (PARTITION BY l_orderkey ORDER BY p + 10 * o, c) AS rejected FROM x)
SELECT l_orderkey, c AS candidate, rejected, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY sc DESC, c) AS rank FROM s WHERE o > 0 AND c <> rejected) WHERE rank <= 2""")
def selected(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", F.concat(F.lpad(F.col("l_linenumber").cast("string"), 3, "0"), F.lit("-"), F.col("l_partkey").cast("string")).alias("candidate"), F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("o"), F.col("l_discount").alias("p"))
    return G.selected(x, "l_orderkey", "candidate", "o", "p", 2).select("l_orderkey", "candidate", "rejected", "rank")


@query("g5_distilled", "SELECT doc_id, '<think>' || lang || '</think>' || chr(10) || chr(10) || '<answer>' || source || '</answer>' AS t FROM documents")
def distilled(spark, d):
    return table(spark, d, "documents").select("doc_id", G.distilled(F.col("lang"), F.col("source")).alias("t"))


@query("t14_text_scores")
def text_scores(spark, d):
    rows = table(spark, d, "conversations").withColumn("next", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))).where("next IS NOT NULL")
    x = rows.select("conv_id", "turn", C.description_scores(F.col("next"), F.col("text")).alias("s"))
    return x.select("conv_id", "turn", *[F.round(f"s.{c}", 6).alias(c) for c in ("token_f1", "rouge_l", "bleu_4", "chrf", "similarity")])


# Streams, read to the end of what is there.


@query("st1_event_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_counts(spark, d):
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    s = spark.readStream.schema(schema).parquet(_folder(d, "events"))
    return S.run_all(s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), f"counts_{uuid.uuid4().hex}", "complete")


def _folder(d: str, name: str) -> str:
    """A glob that a stream can watch: the table's file or folder."""
    return f"{d}/{name}.parque[t]"


@query("st2_stream_split", "SELECT doc_id, doc_id < 40 AS val FROM documents WHERE doc_id < 200")
def stream_split(spark, d):
    schema = spark.read.parquet(f"{d}/documents.parquet").schema
    s = spark.readStream.schema(schema).parquet(_folder(d, "documents"))
    train, val = S.take_skip(s, "doc_id", 200, 0.2)
    both = S.union_streams([train.select("doc_id"), val.select("doc_id")], "part")
    return S.run_all(both.select("doc_id", (F.col("part") == 1).alias("val")), f"split_{uuid.uuid4().hex}")


@query("k4_stream_packs")
def stream_packs(spark, d):
    schema = spark.read.parquet(f"{d}/documents.parquet").schema
    s = spark.readStream.schema(schema).parquet(_folder(d, "documents"))
    return S.run_packed(s, f"packs_{uuid.uuid4().hex}", "lang", "doc_id", "n_chars", 4096).select("pack_key", "length", F.array_join(F.transform("row_ids", lambda x: x.cast("string")), ",").alias("rows"))
