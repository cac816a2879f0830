"""Every query against its SQL over the smallest tables; those without SQL against plain Python."""

import re
from collections import defaultdict

import pytest

from quarry.plans import chat_queries, dataset_queries, table_queries  # noqa: F401
from quarry.plans.registry import ORACLES, QUERIES
from tests.conftest import DATA, same_rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, duck):
    same_rows(QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLES[name]).df())


@pytest.mark.parametrize("name", ["l5_length_groups", "j4_zipped", "p16_rotated_responses", "s8_load_and_split", "s8_sampled_and_shuffled", "u2_interleaved", "u2_interleaved_to_the_last", "a7_paired_correlations", "l11_quantile_filter"])
def test_query_matches_sql_on_more_rows(name, spark):
    import duckdb

    big = DATA.replace("sf0.001", "sf0.1")
    con = duckdb.connect()
    for t in "documents pages embeddings conversations lineitem".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{big}/{t}.parquet'")
    same_rows(QUERIES[name](spark, big).toPandas(), con.sql(ORACLES[name]).df())


def test_yes_no_matches_sql_beside_any_character(spark, tmp_path):
    import duckdb

    beside = ["", *map(chr, [*range(0x600), *range(0x2000, 0x2200), 0xFF4E, 0x1F600, 0x10400])]  # letters, digits, marks, dotted I, Kelvin sign and others
    texts = [None, *(t for x in beside for t in (f"{x}no yes", f"no{x} yes", f"YE{x} {x}No\n{x}yes"))]
    rows = [(i, turn, t) for i, t in enumerate(texts) for turn in (2, 3, 4)] + [(-1, None, "no\u00f1o Yes"), (None, -1, "yes\u00f3 no")]
    spark.createDataFrame(rows, "conv_id long, turn int, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    order = lambda r: tuple((x is None, x) for x in r)
    got = sorted((tuple(r) for r in QUERIES["t10_yes_no"](spark, str(tmp_path)).collect()), key=order)
    want = sorted(con.sql(ORACLES["t10_yes_no"]).fetchall(), key=order)
    assert len(got) == len(rows) and [x for x in zip(got, want, strict=True) if x[0] != x[1]][:5] == []


def test_repetition_matches_plain_python(spark):
    for r in QUERIES["o5_repetition_reward"](spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        w = re.split(r"[ \t\n\x0b\f\r]+", r.text.lower())
        w = [x for x in w if x]
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        assert r.r == pytest.approx(-(1 - len(set(grams)) / len(grams)) if grams else 0.0, abs=1e-6)


def test_negatives_avoid_own_values(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    own = defaultdict(set)
    for r in docs.select("source", "lang").collect():
        own[r.source].add(r.lang)
    got = defaultdict(list)
    for r in QUERIES["l9_negatives"](spark, DATA).collect():
        got[r.source].append(r.negative)
    assert set(got) == set(own)
    assert all(len(set(v)) == len(v) == 3 and not set(v) & own[k] for k, v in got.items())


def test_assigned_boxes_match_all_permutations(spark):
    import itertools

    from quarry.functions.scores import iou

    e = {r.vec_id: list(map(float, r.embedding)) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()}
    for r in QUERIES["j9_assigned_boxes"](spark, DATA).collect():
        v = e[r.vec_id]
        pred, gold = [v[0:4], v[4:8], v[8:12]], [v[1:5], v[5:9]]
        best = max(sum(iou(pred[i], g) for i, g in zip(p, gold)) for p in itertools.permutations(range(3), 2))
        assert abs(sum(map(float, r.iou.split(","))) - best) < 1e-5


def test_stream_packs_hold_rows_once(spark):
    rows = [int(x) for r in QUERIES["k4_stream_packs"](spark, DATA).collect() for x in r.rows.split(",")]
    assert len(rows) == len(set(rows))
    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert n - len(rows) < n / 2  # what is left waits in open bins, one for each key


def test_stream_packs_hold_every_row(spark):
    rows = [int(x) for r in QUERIES["k4_stream_packs"](spark, DATA).collect() for x in r.rows.split(",")]
    assert sorted(rows) == sorted(r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect())


def test_stream_packs_have_whole_lengths(spark):
    n = {r.doc_id: r.n_chars for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "n_chars").collect()}
    packs = QUERIES["k4_stream_packs"](spark, DATA).collect()
    assert max(n.values()) > 4096
    for r in packs:
        ids = [int(x) for x in r.rows.split(",")]
        assert r.length == sum(n[i] for i in ids) and (r.length <= 4096 or len(ids) == 1)


@pytest.mark.parametrize("files", [1, None])
def test_stream_packs_match_next_fit(spark, tmp_path, files):
    from quarry.operators.packing import next_fit
    from quarry.streaming import streams as S

    data = [[(i, k, 7 * i % 23) for i in range(at, at + 60) for k in ("a", None)] + [(900 + at, "b", 1), (901 + at, "c", 40)] for at in (0, 60)]
    for part in data:
        spark.createDataFrame(part, "i long, k string, n long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    s = S.read_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, files_per_trigger=files)
    got = S.run_packed(s, f"t_{files}", "k", "i", "n", 30).collect()
    want = [(k, [r for r, _ in b], sum(n for _, n in b)) for k in ("a", None, "b", "c") for b in next_fit([(i, n) for part in data for i, x, n in part if x == k], 30)]
    assert sorted(map(repr, want)) == sorted(repr((r.pack_key, r.row_ids, r.length)) for r in got)


@pytest.mark.parametrize("name", ["a6_overlap_scores", "t14_text_scores"])
def test_scores_are_in_range(name, spark):
    rows = QUERIES[name](spark, DATA).collect()
    assert rows
    top = 100 if name.startswith("a6") else 1
    assert all(0 <= v <= top for r in rows for k, v in r.asDict().items() if isinstance(v, float))


def test_registry_refuses_second_name():
    from quarry.plans.registry import query

    with pytest.raises(ValueError):
        query(next(iter(QUERIES)))(lambda s, d: None)
