"""The stages of the pipeline, each against what it has to do to its own input."""

import hashlib

import numpy as np
import pytest

import corpus_pipeline
from tests.conftest import DATA


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for i, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, out[-1], DATA).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:5])


def test_only_toxic_ones_go(stages):
    """Scores anew, text by text: the weights of the different words and beginnings that a text holds."""
    import math

    from quarry.llm.linear import word_features
    from quarry.llm.toxicity import fit_toxicity

    labels = stages[0].sparkSession.read.parquet(f"{DATA}/labels.parquet")
    model, _ = fit_toxicity(stages[0], labels)
    weight = dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True))
    want = set()
    for r in stages[0].collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        keys = set(word_features(data, np.array([0, len(data)]))[1].tolist())
        if 1 / (1 + math.exp(-(model.bias + sum(weight.get(k, 0.0) for k in keys)))) < 0.3:
            want.add(r.doc_id)
    assert {r.doc_id for r in stages[1].collect()} == want


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and columns that the operators append elsewhere."""
    names = "score predicted held_out n_tokens size target taken draws shard position n_words kept spans n_shingles component_id comp chunk batch bucket".split()
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(["one two three four five six", "token = 'abcdef123' x", "idiot you moron", "", "  \n", "w " * 30000, "seven eight nine ten eleven twelve"])]
    rows += [rows[0], rows[0], (0, "another text under the id", None, None, None), (None, None, None, None, None), (None, "null id", "de", "s1", 7), (50, None, "fr", "s0", 0), (51, "one two three four five six", "en", None, 5)]
    return spark.createDataFrame([(*r, *range(7, 7 + len(names))) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} long" for n in names))


@pytest.mark.parametrize("number", range(5))
def test_stages_take_any_rows(spark, odd, number):
    f, cols = corpus_pipeline.STAGES[number][1], odd.columns
    rows = f(spark, odd, DATA).collect()
    assert rows and f(spark, odd.limit(0), DATA).count() == 0
    if number < 4:
        assert rows[0].__fields__ == cols
        for i, n in enumerate(cols[5:]):
            assert all(r[n] == 7 + i for r in rows)
        given = {(r.doc_id, r.lang, r.source) for r in odd.collect()}
        assert {(r.doc_id, r.lang, r.source) for r in rows} <= given
    else:
        assert len(rows) == odd.count() and rows[0].__fields__[:3] == ["doc_id", "lang", "source"]
    if number == 0:
        assert sum(1 for r in rows if not (r.text or "").strip()) == 4  # null and empty texts stay
    if number == 1:
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((d is None, d or 0) for d in [0, 0, 1, 2, 3, 4, 5, 6, None, None, 50])
    if number == 2:
        assert len(rows) == odd.count() and not any("abcdef123" in (r.text or "") for r in rows)


def test_one_of_each_group_stays(stages):
    from tests.llm.test_operators import brute_components

    found = brute_components([(r.doc_id, r.text) for r in stages[1].collect()])
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(d for d, _, c in found.elements() if d == c)


def test_secrets_are_gone(stages):
    from tests.llm.test_operators import base_spans

    before = {r.doc_id: r for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert set(before) == set(after)
    for d, r in after.items():
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        assert r.text == before[d].text or "[secret]" in r.text


def test_mix_repeats_whole_rows(stages):
    rows = {r.doc_id: r for r in stages[3].collect()}
    got = stages[4].collect()
    assert got and all(r == rows[r.doc_id] for r in got)


def test_ids_decode(stages):
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    got = stages[5].collect()
    assert len(got) == stages[4].count()
    for r in got:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()


def test_run_is_the_stages(spark, stages):
    key = lambda df: sorted((r.doc_id, r.ids_sha256) for r in df.collect())
    assert key(corpus_pipeline.run(spark, DATA)) == key(stages[5])
