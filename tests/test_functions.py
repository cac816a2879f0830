import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import scores as C
from quarry.functions import text as T
from quarry.operators import agents, packing, preprocess, rewards, sampling, templates
from quarry.operators import datasets as D
from quarry.sources.catalog import Catalog, Dataset, Subset
from quarry.sources.readers import load_dataset, markdown, read_file, read_results, report, write_jsonl
from quarry.sources.syntax import parse


def test_literal_parts():
    assert T.parts_of("aBcBd", ["B"]) == [{"key": "", "content": "a"}, {"key": "B", "content": "c"}, {"key": "B", "content": "d"}]
    assert T.parts_of("Bc", ["B"]) == [{"key": "B", "content": "c"}]
    assert T.parts_of("", ["B"]) == []


def test_regex_parts():
    assert T.parts_of("x1y", [r"\d"], regex=True) == [{"key": "", "content": "x"}, {"key": r"\d", "content": "1"}, {"key": "", "content": "y"}]


@given(st.text(alphabet="abAB \n", max_size=40))
def test_parts_lose_nothing(text):
    assert "".join(p["key"] + p["content"] for p in T.parts_of(text, ["A", "B"])) == text
    assert "".join(p["content"] for p in T.parts_of(text, ["A", "B+"], regex=True)) == text


def test_split_parts_column(spark):
    row = spark.createDataFrame([("aBc",), (None,)], "t string").select(T.split_parts(F.col("t"), ["B"]).alias("p")).collect()
    assert [x.content for x in row[0].p] == ["a", "c"] and row[1].p == []


@pytest.mark.parametrize("text,whole,in_ascii", [("No\u00f1o. Yes", "yes", "no"), ("\u00f3yes, NO", "no", "yes"), ("no\u0303 yes", "no", "no"), ("no9 _yes", None, None), ("\U00010400no yes", "yes", "no"), ("no\U00010400 yes", "yes", "no"), ("\U0001f600no yes", "no", "no"), ("", None, None), (None, None, None)])
def test_yes_no_words(spark, text, whole, in_ascii):
    row = spark.createDataFrame([(text,)], "t string").select(T.first_yes_no(F.col("t")).alias("w"), T.first_yes_no(F.col("t"), ascii_words=True).alias("a")).first()
    assert (row.w, row.a) == (whole, in_ascii)


@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=12))
@settings(max_examples=60)
def test_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert C.lcs(a, b) == table[-1][-1]


def test_identical_texts_score_one():
    assert C.bleu("a b c d e".split(), ["a b c d e".split()]) == pytest.approx(1)
    assert C.chrf("abc def", "abc def") == pytest.approx(1)
    assert C.rouge_l("ab", "ab") == 1 and C.semantic_similarity("open the drawer", "open the drawer") == pytest.approx(1)


def test_opposites_are_capped():
    assert C.semantic_similarity("Do not open the drawer.", "open the drawer") <= C.SEMANTIC_CAP
    assert C.semantic_similarity("turn left at the door", "turn right at the door") <= C.SEMANTIC_CAP


def test_boxes():
    assert C.parse_boxes("a [1, 2, 3, 4] and (1,2),(3,4)") == [[1, 2, 3, 4]]
    assert C.parse_boxes("<box>1 2 3 4 5 6 7 8</box>") == [[1, 2, 3, 4], [5, 6, 7, 8]]
    assert C.parse_boxes("none") == [] and C.matched_iou([], [[0, 0, 1, 1]]) == [0.0]


def test_importance_cases(spark):
    from quarry.operators import rl as R

    logs = F.array(*[F.lit(float(np.log(x))) for x in (0.5, 1.5, 3.0, 5.0)])
    zero, mask = F.array(*[F.lit(0.0)] * 4), F.array(*[F.lit(1)] * 4)
    get = lambda mode: [round(x, 6) for x in spark.range(1).select(R.rollout_weights(logs, zero, mask, mode, 2.0).alias("w")).first().w]
    assert get("token_truncate") == [0.5, 1.5, 2.0, 2.0] and get("token_mask") == [0.5, 1.5, 0.0, 0.0]
    same = lambda v: F.array(*[F.lit(float(np.log(v)))] * 4)
    seq = lambda v, mode: spark.range(1).select(R.rollout_weights(same(v), zero, mask, mode, 2.0).alias("w")).first().w[0]
    assert seq(3.0, "sequence_truncate") == pytest.approx(2) and seq(3.0, "sequence_mask") == 0 and seq(1.0, "sequence_mask") == pytest.approx(1)


@pytest.mark.parametrize("pred,gold,want", [("\\boxed{\\frac{1}{2}}", "0.5", 1), ("<answer>3</answer>", "\\boxed{3.0}", 1), ("\\boxed{x+1}", "\\boxed{x + 1}", 1), ("2", "3", 0), ("", "3", 0), (None, "3", 0), ("\\boxed{1,000}", "1000", 1)])
def test_math(pred, gold, want):
    assert rewards.math_equal(pred, gold) == want


def test_evaluate_is_closed():
    assert rewards.evaluate("__import__('os')") is None and rewards.evaluate("1/0") is None and rewards.evaluate("2**9") is None


@given(st.lists(st.integers(1, 12), max_size=40))
@settings(max_examples=60)
def test_packing_invariants(sizes):
    items = list(enumerate(sizes))
    for bins in (packing.best_fit(items, 10), list(packing.next_fit(items, 10))):
        assert sorted(r for b in bins for r, _ in b) == list(range(len(sizes)))
        assert all(sum(n for _, n in b) <= 10 or len(b) == 1 for b in bins)


def test_next_fit_example():
    assert [[n for _, n in b] for b in packing.next_fit(enumerate([5, 5, 3, 8, 1, 2, 9]), 8)] == [[5], [5, 3], [8], [1, 2], [9]]


def test_specs():
    s = parse("HF::a/b:x/y#7", lambda _: False)
    assert (s.hub, s.source, s.subsets, s.rows) == ("hf", "a/b", ("x", "y"), 7)
    assert parse("/p:q#1", lambda p: p == "/p:q#1").source == "/p:q#1"
    with pytest.raises(ValueError):
        parse("zz::a", lambda _: False)


def test_catalog():
    c = Catalog()
    c.register_info(json.dumps([{"dataset_name": "n", "hf_dataset_id": "org/n1", "subsets": ["default", "b"]}]))
    assert c.find("n").hf_id == "org/n1" and c.find("other/n1").name == "n" and c.find("org/n1", "hf").name == "n" and c.find("zz").path == "zz"
    with pytest.raises(ValueError):
        c.register(Dataset("n"))
    with pytest.raises(ValueError):
        Catalog.choose(Dataset("x", subsets=(Subset("a"), Subset("b"))), ())


def test_files_to_rows(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps({"instruction": f"i{k}", "input": "x" if k % 2 else "", "output": f"o{k}"}) for k in range(20)))
    (tmp_path / "b.csv").write_text("system,query,response\ns,q,3.3\n,q2,r2\n")
    (tmp_path / "c.json").write_text(json.dumps([{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}]))
    train, val = load_dataset(spark, str(tmp_path / "a.jsonl"), split_ratio=0.1)
    assert (train.count(), val.count()) == (18, 2)
    csv = load_dataset(spark, str(tmp_path / "b.csv"))[0].collect()
    assert [[(m.role, m.content) for m in r.messages] for r in csv] == [[("system", "s"), ("user", "q"), ("assistant", "3.3")], [("system", ""), ("user", "q2"), ("assistant", "r2")]]
    assert [(m.role, m.content) for m in load_dataset(spark, str(tmp_path / "c.json"))[0].first().messages] == [("user", "h"), ("assistant", "g")]
    write_jsonl(train.select("messages"), str(tmp_path / "out"), append=True)
    assert spark.read.json(str(tmp_path / "out")).count() == 18
    (tmp_path / "r.json").write_text(json.dumps({"results": [{"model": "m", "acc": 1.0}, {"model": "m", "acc": 0.0}]}))
    assert "0.5000" in markdown(report(read_results(spark, str(tmp_path / "r.json")).withColumn("b", F.lit("x")), "model", "b", "acc"))
    with pytest.raises(ValueError):
        read_file(spark, "x.zip")


def test_ambiguous_aliases_stay(spark):
    df = spark.createDataFrame([("a", "b", "c")], "response string, answer string, Query string")
    assert preprocess.alias_columns(df).columns == ["response", "answer", "query"]


def test_interleave_all_exhausted(spark):
    a, b = spark.range(30).toDF("id"), spark.range(7).toDF("id")
    rows = sampling.interleave([a, b], [1.0, 1.0], "id", stop="all_exhausted").collect()
    assert {r.id for r in rows if r.source == 0} == set(range(30)) and {r.id for r in rows if r.source == 1} == set(range(7))
    assert sampling.interleave([a, b.limit(0)], [1.0, 1.0], "id").count() == 0


def test_sampling_edges(spark):
    df = spark.range(10).toDF("id")
    assert sampling.sample(df, 25, "id").count() == 25 and sampling.sample(df, 10, "id").count() == 10 and sampling.sample(df, 3, "id").count() == 3
    assert sampling.sample(df.limit(0), 5, "id").count() == 0
    with pytest.raises(RuntimeError):
        sampling.resample(df.withColumn("ok", F.lit(False)), "ok", "id", 1)


def test_truncation_keeps_protected(spark):
    df = spark.createDataFrame([([1, 9, 3, 4, 9, 6], [1, 9, 3, 4, 9, 6])], "input_ids array<int>, labels array<int>")
    assert templates.truncate(df, 4, "right", protected=[9]).first().input_ids == [1, 9, 3, 9]
    assert templates.truncate(df, 4, "left", protected=[9]).first().input_ids == [9, 4, 9, 6]
    assert templates.truncate(df, 4, "left").first().labels == [-100, 4, 9, 6]
    assert templates.truncate(df, 4, "delete").count() == 0


def test_scaled_parts():
    parts = templates.scaled_parts("Thought: t\nAction: a\nAction Input: b", templates.LOSS_SCALES["react"])
    assert parts == [("Thought:", 1.0), (" t\n", 1.0), ("Action:", 2.0), (" a\n", 2.0), ("Action Input:", 2.0), (" b", 2.0)]
    assert templates.scaled_parts("<think>\n</think>\n\nx", templates.LOSS_SCALES["ignore_empty_think"])[0][1] == 0.0


def test_scaled_segments(spark):
    seg = F.array(F.struct(F.lit("a<tool_call>b</tool_call>c").alias("text"), F.lit("response").alias("kind"), F.lit(1.0).alias("weight")))
    got = spark.range(1).select(templates.scale_responses(seg, "hermes").alias("s")).first().s
    assert [(x.text, x.weight) for x in got] == [("a", 1.0), ("<tool_call>b</tool_call>", 2.0), ("c", 1.0)]


def test_dynamic_eos(spark):
    x = spark.createDataFrame([([-100, 5, -100, -100, 7], [1, 5, 8, 9, 7])], "l array<int>, i array<int>")
    assert x.select(templates.dynamic_eos(F.col("l"), F.col("i"), [8, 9]).alias("y")).first().y == [-100, 5, 8, 9, 7]


@pytest.mark.parametrize("name", sorted(agents.FORMATS))
def test_calls_round_trip(name):
    f = agents.FORMATS[name]
    calls = [{"name": "find", "arguments": '{"a": "b"}'}]
    if name != "hunyuan_hermes":  # it reads another form than it writes
        got = f.calls(f.write(calls))
        assert [(c["name"], agents.lenient_json(c["arguments"])) for c in got] == [("find", {"a": "b"})]
    tools = [{"name": "find", "description": "d", "parameters": {"type": "object"}}]
    told = f.prompt(tools, "sys") + (f.question(tools, "ask") if f.question else "")
    assert "find" in told and ('"object"' in told or "<parameters>" in told) and "<<" not in told and "r1" in f.results(["r1"])


def test_agent_prompts():
    tool = {"name": "find", "description": "Finds.", "parameters": {"q": 1}}
    line = 'find: Call this tool to interact with the find API. What is the find API useful for? Finds. Parameters: {"q": 1} Format the arguments as a JSON object.'
    assert agents.FORMATS["react_en"].prompt([tool], None).startswith(f"Answer the following questions as best you can. You have access to the following tools:\n\n{line}\n\nUse the following format:")
    assert "one of [find,find]" in agents.FORMATS["react_en"].prompt([tool, {"type": "function", "function": tool}], None)
    wrapped = json.dumps({"type": "function", "function": tool})
    assert agents.FORMATS["hermes"].prompt([tool], "S").startswith("S\n\n# Tools\n\nYou may call one or more") and f"<tools>\n{wrapped}\n</tools>" in agents.FORMATS["hermes"].prompt([tool], "S")
    assert agents.FORMATS["hunyuan_hermes"].prompt([tool], "").startswith("# Tools")
    assert agents.FORMATS["mistral"].prompt([tool], "S") == f"S[AVAILABLE_TOOLS]{wrapped}[/AVAILABLE_TOOLS]"
    assert agents.FORMATS["llama3"].prompt([tool], None) == "" and agents.FORMATS["llama3"].question([tool], "Q?").endswith(json.dumps(tool, indent=4) + "\n\nQ?")
    assert agents.FORMATS["glm4"].prompt([tool], "S").startswith("# 可用工具\n\n## find\n\n{")
    tree = agents.FORMATS["qwen3_coder"].prompt([{"name": "f", "description": " d ", "parameters": {"type": "object", "properties": {"q": {"type": "string", "enum": ["a"]}}, "required": ["q"]}, "strict": True}], "S")
    assert tree.startswith("S\n\n# Tools\n\nYou have access to the following functions:\n\n<tools>\n<function>\n<name>f</name>\n<description>d</description>\n<parameters>\n<parameter>\n<name>q</name>\n<type>string</type>\n<enum>[\"a\"]</enum>\n</parameter>\n<required>[\"q\"]</required>\n</parameters>\n<strict>true</strict>\n</function>\n</tools>")
    assert agents.FORMATS["hunyuan_hermes"].calls('<tool_call>f\n```json\n{"a": 1}\n```</tool_call>') == [{"name": "f", "arguments": '{"a": 1}'}]
    assert agents.FORMATS["hermes"].calls("Thought\nACTION: f\naction input: {}\nObservation:") == [{"name": "f", "arguments": "{}"}]


def test_agent_columns(spark):
    df = spark.createDataFrame([('<tool_call>{"name": "f", "arguments": {"x": 1}}</tool_call>', '[{"name": "f"}]'), (None, None)], "t string, tools string")
    rows = df.select(agents.tool_calls(F.col("t")).alias("c"), agents.tool_prompt(F.col("tools"), F.lit("s")).alias("p")).collect()
    assert rows[0].c[0].name == "f" and "<tools>" in rows[0].p and rows[1].c == [] and rows[1].p == "s"


def _messages(df):
    return [[(m.role, m.content) for m in r.messages] for r in df.collect()]


def test_preparations(spark):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    assert _messages(D.alpaca_zh(make([("q", "输入：x", "r")], "instruction string, input string, output string"))) == [[("user", "q\nx"), ("assistant", "r")]]
    assert _messages(D.preference_dialogues(make([("\n\nHuman: a\n\nAssistant: b", "\n\nHuman: a\n\nAssistant: c")], "chosen string, rejected string"))) == [[("user", "a"), ("assistant", "b")]]
    assert D.sudoku(make([("." * 18, "1" * 18)], "puzzle string, solution string")).first().messages[1].content == "1" * 9 + "\n" + "1" * 9
    assert _messages(D.literal_conversations(make([("[{'from': 'human', 'value': 'a'} {'from': 'gpt', 'value': 'b'}]",)], "conversations string"))) == [[("user", "a"), ("assistant", "b")]]
    assert D.human_or_model(make([("q", ["h"], ["c", "d"])], "question string, human_answers array<string>, chatgpt_answers array<string>")).count() == 2
    assert D.context_questions(make([("a [SEP] c", "q"), ("bad", "q")], "text1 string, text2 string")).count() == 1
    assert D.delimited_chat(make([("User: a Assistant: b User: c", "d"), ("Assistant: x", "y")], "input string, output string")).count() == 1
    assert D.function_answers(make([("q", '[{"name": "f", "arguments": {"x": "1"}}]')], "query string, answers string")).first().messages[1].role == "tool_call"
    assert D.multi_labels(make([([0, 1, 1],)], "flags array<int>")).first().label == [1, 2]
    grit = make([("a dog and cat", [(0, 5, [0.0, 0.0, 1.0, 1.0]), (10, 13, [0.0, 0.0, 1.0, 1.0])]), ("x", [(0, 5, [0.0]), (3, 6, [0.0])])], "caption string, ref_exps array<struct<start:int,end:int,box:array<double>>>")
    assert D.grounded_captions(grit).first().objects.ref == ["a dog", "cat"] and D.grounded_captions(grit).count() == 1
    files = make([("d/1.png",)], "path string")
    assert D.listed_images(make([(1, ["1.png"]), (2, ["1.png", "2.png"])], "id int, images array<string>"), "d", files, "id").count() == 1
    assert D.video_options(make([("q", ["x", "y"], 1)], "question string, options array<string>, answer int")).first().messages[1].content == "B"
    assert len(D.PREPARATIONS) > 45


@pytest.mark.parametrize("partitions", [8, 211])
def test_ordinals_of_wide_rows(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = spark.range(0, 200_000, 1, 9).select("id", F.md5(F.col("id").cast("string")).alias("m"), F.repeat(F.lit("x"), 40).alias("wide"))
        out = sampling.shuffled(df, "id", name="i")
        assert out.agg(F.count_distinct("i"), F.min("i"), F.max("i")).first() == (200_000, 0, 199_999)
        w = Window.orderBy(sampling.shuffle_key(42, "id"), "id")
        assert out.withColumn("j", F.row_number().over(w) - 1).where("i <> j").isEmpty()
        for ratio in (0.3, 0.5):
            train, val = sampling.split(df, ratio, "id")
            both = train.select("id").union(val.select("id"))
            assert val.count() == int(200_000 * ratio) and both.count() == both.distinct().count() == 200_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_ordinals_of_ties_and_nulls(spark):
    rows = [(i % 7 if i % 11 else None, f"r{i % 50}") for i in range(3000)]
    got = preprocess.ordinal(spark.createDataFrame(rows, "k long, v string").repartition(5), "k").collect()
    assert sorted(r.ordinal for r in got) == list(range(3000))
    keys = [r.k for r in sorted(got, key=lambda r: r.ordinal)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))


def test_ordinal_is_dense(spark):
    n = [r.ordinal for r in preprocess.ordinal(spark.range(1000).toDF("id").repartition(7), "id").orderBy("id").collect()]
    assert n == list(range(1000)) and preprocess.ordinal(spark.range(0).toDF("id"), "id").count() == 0


def test_async_reward(spark):
    async def score(text):
        return float(len(text))

    assert [r.reward for r in rewards.async_reward(spark.createDataFrame([("a",), ("bb",)], "t string"), score, "t").collect()] == [1.0, 2.0]


def test_route_fails_on_two(spark):
    from quarry.operators.joins import route

    df, routes = spark.createDataFrame([("a",)], "tag string"), spark.createDataFrame([("a", 1), ("a", 2)], "tag string, t int")
    with pytest.raises(Exception, match="no single route"):
        route(df, routes, "tag").collect()


def test_random_assignments():
    import itertools

    rng = random.Random(1)
    for _ in range(40):
        n, m = rng.randint(1, 4), rng.randint(1, 4)
        c = np.array([[rng.random() for _ in range(m)] for _ in range(n)])
        k = min(n, m)
        best = min(sum(c[i, j] for i, j in zip(p, q)) for p in itertools.permutations(range(n), k) for q in itertools.permutations(range(m), k))
        assert sum(c[i, j] for i, j in C.assign(c)) == pytest.approx(best)


def test_passage_matches_next_fit():
    rng = random.Random(4)
    for _ in range(150):
        sizes = [rng.choice([0, 1, 3, 9, 10, 11, 25]) for _ in range(rng.randrange(1, 12))]
        runs = packing.passage(np.array(sizes), 10)
        for size in range(-1, 10):
            bins = list(packing.next_fit(enumerate(sizes), 10, [(None, size)] if size >= 0 else None))
            last = sum(n for _, n in bins[-1])
            want = (last, len(bins) - 1) if last < 10 else (-1, len(bins))
            _, grows, left, closed = max(r for r in runs if r[0] <= size)
            assert (size + left if grows else left, closed) == want


@pytest.mark.parametrize("shards", [1, 2, 7, 60])
def test_next_fit_is_the_same_over_shards(spark, shards):
    rng = random.Random(shards)
    items = [(3 * i, rng.choice([0, 0, 1, 2, 5, 40, 99, 100, 130])) for i in range(200)]
    df = spark.createDataFrame(items, "i long, n long").repartition(5)
    got = {r.pack_id: (r.row_ids, r.length) for r in packing.pack(df, "i", "n", 100, "next_fit", shards).collect()}
    bins = list(packing.next_fit(items, 100))
    assert got == {k: ([r for r, _ in b], sum(n for _, n in b)) for k, b in enumerate(bins)}


def test_hard_negatives_are_cut_and_padded(spark):
    data = [(i, ["a", "p", *[f"n{j}" for j in range(1 + i % 8)]]) for i in range(400)]
    df = spark.createDataFrame(data, "i long, parts array<string>")
    run = lambda d, seed=42: dict(d.select("i", sampling.hard_negatives(F.col("parts"), "i", 5, seed)).collect())
    got, drawn = run(df), {}
    for i, parts in data:
        n = len(parts) - 2
        assert len(got[i]) == 7 and got[i][: min(n, 5) + 2] == parts[:7]
        drawn.setdefault(n, set()).update(got[i][n + 2 :])
    assert all(drawn[n] == {"p", *[f"n{j}" for j in range(n - 1)]} for n in (1, 2, 3, 4))
    assert got == run(df.repartition(7)) != run(df, 43)
    with pytest.raises(Exception, match="no hard negative"):
        run(spark.createDataFrame([(1, ["a", "p"])], "i long, parts array<string>"))


def test_subsets_and_splits_are_read_apart(spark, tmp_path):
    for sub, split, n in (("a", "train", 2), ("a", "test", 3), ("b", "train", 5)):
        spark.range(n).selectExpr(f"'{sub}-{split}' AS query", "string(id) AS response").coalesce(1).write.parquet(f"{tmp_path}/{sub}/{split}.parquet")
    c = Catalog()
    c.register(Dataset("two", path=str(tmp_path), subsets=(Subset("a", "a", split=("train", "test")), Subset("b", "b"))))
    rows = [r.messages[0].content for r in load_dataset(spark, "two:all", catalog=c)[0].collect()]
    assert sorted(rows) == ["a-test"] * 3 + ["a-train"] * 2 + ["b-train"] * 5
    assert len(load_dataset(spark, "two:b", catalog=c)[0].collect()) == 5


def test_validation_rows_are_added(spark, tmp_path):
    from quarry.sources.readers import save_validation

    df = spark.createDataFrame([(1, None), (2, "x")], "id long, t string")
    path = save_validation(df, str(tmp_path))
    assert save_validation(df, f"{tmp_path}/") == path and path.endswith("/val_dataset.jsonl")
    assert sorted((r.id, r.t) for r in read_file(spark, path).collect()) == [(1, None), (1, None), (2, "x"), (2, "x")]


def test_digest_is_that_of_sorted_json(spark):
    import hashlib

    from quarry.operators.joins import row_digest

    row = {"b": "é\n", "a": [1, 2], "m": {"y": 1.5, "x": None}}
    df = spark.createDataFrame([(row["b"], row["a"], (1.5, None), ["c"])], "b string, a array<int>, m struct<y:double,x:string>, choices array<string>")
    assert df.select(row_digest(df, "choices").alias("d")).first().d == hashlib.md5(json.dumps(row, sort_keys=True).encode()).hexdigest()


def test_caption_ranking_takes_other_rows_captions(spark):
    df = spark.createDataFrame([(i, [f"c{i}", f"c{i + 1}"]) for i in range(40)], "id long, captions array<string>")
    for r in D.caption_ranking(df, "id", 7).collect():
        assert len(set(r.negatives)) == 7 and not set(r.negatives) & set(r.captions)
