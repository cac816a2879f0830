"""Queries over the dataset preparations: raw columns made from the test tables, prepared, and shown as text.

Every query takes all documents; id, l, s and n stand for the document's id, language, source and length, and the raw
columns of each shape are expressions of these.  Where a preparation picks by hash, the choice is one of one here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators import datasets as D
from quarry.operators import preprocess as P
from quarry.plans.chat_queries import shown
from quarry.plans.registry import query, table

BASE = "d AS (SELECT doc_id AS id, coalesce(lang, '-') AS l, coalesce(source, '-') AS s, n_chars AS n FROM documents)"
NL = "chr(10)"


def base(spark, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("-")).alias("l"), F.coalesce("source", F.lit("-")).alias("s"), F.col("n_chars").alias("n"))


def messages() -> Column:
    return shown(F.col("messages"))


def add(name: str, raw: dict[str, str], prepare: Callable[[DataFrame], DataFrame], sql: str, where: str = "true", out: Callable[[], Column] = messages) -> None:
    """Register ds_`name`. raw: Spark expressions of the raw columns; sql: what DuckDB makes of d for `out`, where rows stay."""

    @query(f"ds_{name}", f"WITH {BASE} SELECT id, {sql} AS out FROM d WHERE {where}")
    def run(spark, folder):
        df = base(spark, folder).select("id", *[F.expr(e).alias(c) for c, e in raw.items()])
        return prepare(df).select("id", out().alias("out"))


def turn_array(*turns: tuple[str, str]) -> str:
    """A Spark expression of messages; roles and contents are expressions."""
    return "array(" + ", ".join(f"named_struct('role', {r}, 'content', {c})" for r, c in turns) + ")"


def listed(c: str) -> Callable[[], Column]:
    return lambda: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


# Texts.

add("alpaca_zh", {"instruction": "concat('i', l)", "input": "if(id % 2 = 0, concat('输入：', s), '')", "output": "concat('o', s)"}, D.alpaca_zh,
    f"'user=i' || l || CASE WHEN id % 2 = 0 THEN {NL} || s ELSE '' END || '|assistant=o' || s")
add("long_alpaca", {"instruction": "l", "input": "''", "output": "if(id % 2 = 0, concat('Answer: ', s), concat(s, 'Answer: '))"}, D.long_alpaca, "'user=' || l || '|assistant=' || s || CASE WHEN id % 2 = 0 THEN '' ELSE 'Answer: ' END")
add("ruozhiba", {"title": "if(id % 3 = 0, concat(id, '. ', l), l)", "abs": "if(id % 2 = 0, s, '')"}, D.ruozhiba, "'assistant=' || CASE WHEN id % 3 = 0 THEN ' ' ELSE '' END || l || CASE WHEN id % 2 = 0 THEN '，' || s ELSE '' END")
add("math_pairs", {"query": "concat(id, '+1')", "response": "string(id + 1)"}, lambda df: D.math_pairs(df).withColumn("id", F.split_part(F.get("messages", F.lit(0))["content"], F.lit("+"), F.lit(1)).cast("long")), "'user=' || id || '+1|assistant=' || (id + 1)")
add("assistant_bench", {"messages": turn_array(("'system'", "if(id % 2 = 0, 'You are a helpful assistant.', l)"), ("'user'", "l"), ("'assistant'", "CASE id % 5 WHEN 0 THEN 'I am MOSS' WHEN 1 THEN 'x User: y' ELSE s END"))}, D.assistant_bench,
    "CASE WHEN id % 2 = 0 THEN '' ELSE 'system=' || l || '|' END || 'user=' || l || '|assistant=' || s", "id % 5 > 1")
add("multi_plugin", {"messages": turn_array(("'system'", "concat('\"name\": \"a\" \"name\":\"', if(id % 3 = 0, 'b', 'a'), '\"')"), ("'user'", "l"))}, D.multi_plugin, "'system=\"name\": \"a\" \"name\":\"b\"|user=' || l", "id % 3 = 0")
add("instruction_kinds", {"kind": "l", "input": "string(id)", "target": "s"}, lambda df: D.instruction_kinds(df, ("en", "de")).withColumn("id", F.get("messages", F.lit(0))["content"].cast("long")), "'user=' || id || '|assistant=' || s", "l IN ('en', 'de')")
add("text_to_sql", {"sql_context": "l", "sql_prompt": "string(id)", "sql_explanation": "s", "sql": "'SELECT 1'"}, D.text_to_sql,
    f"'user=Sql Table information:' || {NL} || l || {NL} || id || '|assistant=Let''s think step by step:' || {NL} || s || {NL} || 'So the final sql is:' || {NL} || 'SELECT 1'")
add("tool_conversations", {"messages": f"if(id % 3 = 0, {turn_array((chr(39) + 'user' + chr(39), 'l'))}, {turn_array((chr(39) + 'user' + chr(39), 'l'), ('if(id % 3 = 1, ' + chr(39) + 'caller' + chr(39) + ', ' + chr(39) + 'conclusion' + chr(39) + ')', 's'))})"}, D.tool_conversations, "'user=' || l || '|assistant=' || s", "id % 3 > 0")
add("math_with_answer", {"input": "l", "output": "s", "answer": "string(id)"}, D.math_with_answer, f"'user=' || l || '|assistant=' || s || {NL} || {NL} || 'Answer: ' || id")
add("law_chapters", {"type": "l", "title": "s", "chapter1": "if(id % 2 = 0, 'c1', '')", "chapter2": "''", "chapter3": "if(id % 3 = 0, 'c3', '')", "response": "string(id)"}, D.law_chapters,
    f"'assistant=' || l || {NL} || s || {NL} || CASE WHEN id % 2 = 0 THEN 'c1' || {NL} ELSE '' END || CASE WHEN id % 3 = 0 THEN 'c3' || {NL} ELSE '' END || id")
add("code_problems", {"code_with_problem": "concat('# ', l, '\\n```python\\n', s, '\\n```')", "explanation_only": "string(id)"}, D.code_problems, f"'user=' || l || {NL} || '|assistant=```python' || {NL} || s || {NL} || '```' || {NL} || {NL} || id")
add("sentence_pairs", {"sentence1": "l", "sentence2": "s", "score": "double(id % 6)"}, lambda df: D.sentence_pairs(df, 4.0), "'user=' || l || '/user=' || s || '/' || (id % 6) || '.0'", "id % 6 >= 4",
    lambda: F.concat(messages(), F.lit("/"), shown(F.get("positive_messages", F.lit(0))), F.lit("/"), F.col("label").cast("string")))
SIMILAR = f"'user=Task: Based on the given two sentences, provide a similarity score between 0.0 and 5.0.' || {NL} || 'Sentence 1: ' || l || {NL} || 'Sentence 2: ' || s || {NL} || 'Similarity score: '"
add("sentence_scores", {"sentence1": "l", "sentence2": "s", "score": "double(id % 11) / 2"}, D.sentence_scores, SIMILAR + " || '|assistant=' || printf('%.1f', (id % 11) / 2.0::DOUBLE)")
add("sentence_regression", {"sentence1": "l", "sentence2": "s", "score": "double(id % 5)"}, lambda df: D.sentence_scores(df, generate=False), SIMILAR + " || '/' || (id % 5) || '.0'", out=lambda: F.concat(messages(), F.lit("/"), F.col("label").cast("string")))
add("rerank_lists", {"query": "l", "positive": "array(s, string(id))", "negative": "if(id % 2 = 0, array('n'), array('n', l))"}, D.rerank_lists, "'user=' || l || '/assistant=' || s || ';assistant=' || id || '/assistant=n' || CASE WHEN id % 2 = 0 THEN '' ELSE ';assistant=' || l END",
    out=lambda: F.concat_ws("/", messages(), *[F.array_join(F.transform(c, shown), ";") for c in ("positive_messages", "negative_messages")]))
add("literal_conversations", {"conversations": "concat(\"[{'from': 'human', 'value': '\", l, \"'} {'from': 'gpt', 'value': '\", s, id, \"'}]\")"}, D.literal_conversations, "'user=' || l || '|assistant=' || s || id")
add("chat_rooms", {"system": "l", "history": "array(array('A', s), array('B', string(id)))", "query": "if(id % 4 = 0, '', s)", "response": "l"}, D.chat_rooms, f"'system=' || l || {NL} || {NL} || 'Chat history:' || {NL} || 'A: ' || s || {NL} || 'B: ' || id || '|user=' || s || '|assistant=' || l", "id % 4 > 0")
add("countdown", {"nums": "array(int(id % 10), 3, 7)", "target": "int(id % 50)"}, D.countdown,
    f"'user=Using the numbers [' || (id % 10) || ', 3, 7], create an equation that equals ' || (id % 50) || '.' || {NL} || 'You can use basic arithmetic operations (+, -, *, /) and each number can only be used once. Show your work in <think> </think> tags. And return the final equation and answer in <answer> </answer> tags, for example <answer> (1 + 2) / 3 * 4 = 4 </answer>.'")
add("context_questions", {"text1": "if(id % 3 = 0, l, concat(l, '[SEP]', s))", "text2": "string(id)"}, D.context_questions, f"'user=Task: Question Generation' || {NL} || 'Context: ' || s || {NL} || 'Answer: ' || l || {NL} || 'Question:|assistant=' || id", "id % 3 > 0")
add("preference_dialogues", {"chosen": "concat('\\n\\nHuman: ', l, '\\n\\nAssistant: ', s, if(id % 2 = 0, concat('\\n\\nHum: ', id, '\\n\\nAssistant: z'), ''))", "rejected": "concat('\\n\\nHuman: ', l, '\\n\\nAssistant: no ', id)"}, D.preference_dialogues,
    "'user=' || l || '|assistant=' || s || CASE WHEN id % 2 = 0 THEN '|user=' || id || '|assistant=z' ELSE '' END || '/no ' || id", out=lambda: F.concat(messages(), F.lit("/"), F.col("rejected_response")))
add("function_answers", {"query": "l", "answers": "concat('[{\"name\": \"f\", \"arguments\": {\"x\": \"', id, '\"}}]')"}, D.function_answers, "'user=' || l || '|tool_call={\"name\":\"f\",\"arguments\":{\"x\":\"' || id || '\"}}'")
add("function_actions", {"query": "l", "answers": "concat('[{\"name\": \"f\", \"arguments\": {\"x\": \"', id, '\"}}, {\"name\": \"g\", \"arguments\": {}}]')"}, lambda df: D.function_answers(df, text=True),
    f"'user=' || l || '/Action: f' || {NL} || 'Action Input: {{\"x\":\"' || id || '\"}}' || {NL} || 'Action: g' || {NL} || 'Action Input: {{}}'", out=lambda: F.concat(messages(), F.lit("/"), F.col("solution")))
add("preference_history", {"context": "array(named_struct('role', 'human', 'text', l), named_struct('role', 'Assistant', 'text', s), named_struct('role', 'human', 'text', string(id)))", "chosen": "named_struct('text', s)", "rejected": "named_struct('text', l)"}, D.preference_history,
    "'user=' || l || '|assistant=' || s || '|user=' || id || '|assistant=' || s || '/' || l", out=lambda: F.concat(messages(), F.lit("/"), F.col("rejected_response")))
add("emoji_free", {"query": "concat(l, '❤️')", "response": "concat(s, '️', id)"}, D.emoji_free, "'user=' || l || '❤|assistant=' || s || id")
add("delimited_chat", {"input": "CASE id % 3 WHEN 0 THEN concat('User: ', l, ' Assistant: ', s, ' User: x') WHEN 1 THEN concat('User: ', l) ELSE concat('Assistant: ', s) END", "output": "string(id)"}, D.delimited_chat,
    "'user=' || l || CASE WHEN id % 3 = 0 THEN '|assistant=' || s || '|user=x' ELSE '' END || '|assistant=' || id", "id % 3 < 2")
add("described_functions", {"functions_description": "concat(l, '\\n\\n', s, if(id % 2 = 0, '\\n\\n', ''))", "messages": turn_array(("'system'", "l"), ("'user'", "s"))}, D.described_functions, "l || ',' || s || '/user=' || s", out=lambda: F.concat(listed("tools")(), F.lit("/"), messages()))
add("context_instructions", {"instruction": "l", "context": "if(id % 2 = 0, s, '')", "response": "string(id)"}, D.context_instructions, f"'user=' || CASE WHEN id % 2 = 0 THEN 'Here gives some useful information:' || {NL} || s || {NL} ELSE '' END || l || '|assistant=' || id")
add("preference_mix", {"source": "if(id % 3 = 0, 'toxic-dpo-v0.2', if(id % 3 = 1, null, s))", "l": "l"}, D.preference_mix, "l", "id % 3 > 0", lambda: F.col("l"))
add("sudoku", {"puzzle": "concat(repeat('.', 9), repeat(string(id % 9 + 1), 9))", "solution": "repeat('12', 9)"}, D.sudoku, f"'user=Solve the sudoku puzzle:' || {NL} || '000000000' || {NL} || repeat(CAST(id % 9 + 1 AS VARCHAR), 9) || '|assistant=121212121' || {NL} || '212121212'")


def _two(classify: bool):
    def prepare(df: DataFrame) -> DataFrame:
        out = D.human_or_model(df, classify)
        return out.withColumn("id", F.regexp_extract(F.get("messages", F.lit(0))["content"], r"Question: (\d+)", 1).cast("long"))

    return prepare


HUMAN = f"'user=Classification Task: Are the following responses from a human or from ChatGPT?' || {NL} || 'Question: ' || id || {NL} || 'Answer: ' || CASE k WHEN 0 THEN l ELSE s END || {NL} || 'Category: Human, ChatGPT' || {NL} || 'Output:'"
ANSWERS = {"question": "string(id)", "human_answers": "array(l)", "chatgpt_answers": "if(id % 2 = 0, array(s), array())"}
for _name, _classify, _tail in (("human_or_model", False, "'|assistant=' || CASE k WHEN 0 THEN 'Human' ELSE 'ChatGPT' END"), ("human_or_model_labels", True, "'/' || k")):

    @query(f"ds_{_name}", f"WITH {BASE} SELECT id, {HUMAN} || {_tail} AS out FROM d, range(2) t(k) WHERE k = 0 OR id % 2 = 0")
    def _human(spark, folder, classify=_classify):
        df = base(spark, folder).select("id", *[F.expr(e).alias(c) for c, e in ANSWERS.items()])
        out = F.concat(messages(), F.lit("/"), F.col("label").cast("string")) if classify else messages()
        return _two(classify)(df).select("id", out.alias("out"))


# Media.

add("constant_query", {"response": "concat(l, id)"}, D.constant_query, "'user=Describe the picture.|assistant=' || l || id")
add("captions", {"caption": "concat(if(id % 2 = 0, 'This image displays: ', ''), l, id, ' && ', s)"}, lambda df: D.captions(df, ("What?",)), "'user=What?|assistant=' || l || id")
add("dense_captions", {"cap_seg": "concat(\"{'global_caption': '\", l, id, \"', 'x': 1}\")"}, D.dense_captions, "'user=Describe the picture.|assistant=' || l || id")
add("speech", {"text": "concat(l, ' ', s, ' ', id)"}, D.speech, "'user=Transcribe the speech.|assistant=' || l || s || id")
OPTIONS = {"question": "l", "options": "array(s, string(id), 'z')", "answer": "int(id % 3)"}
ASKED = f"'user=' || l || {NL} || 'A. ' || s || {NL} || 'B. ' || id || {NL} || 'C. z'"
add("video_options", OPTIONS, D.video_options, ASKED + " || '|assistant=' || chr(CAST(65 + id % 3 AS INTEGER))")
add("video_option_labels", OPTIONS, lambda df: D.video_options(df, classify=True), ASKED + " || '/' || (id % 3)", out=lambda: F.concat(messages(), F.lit("/"), F.col("label").cast("string")))
add("first_video_question", {"global": "if(id % 2 = 0, array(named_struct('question', l, 'answer', s), named_struct('question', 'x', 'answer', 'y')), array())"}, D.first_video_question, "'user=' || l || '|assistant=' || s", "id % 2 = 0")
add("any_video_question", {"query": "if(id % 3 = 0, l, 'None')", "question_1": "if(id % 3 = 1, s, 'None')", "question_2": "string(id)", "response": "l"}, D.any_video_question, "'user=' || CASE id % 3 WHEN 0 THEN l WHEN 1 THEN s ELSE CAST(id AS VARCHAR) END || '|assistant=' || l")
add("caption_pairs", {"captions": "array(l, s)"}, D.caption_pairs, "'user=<image>/user=' || l", out=lambda: F.concat(messages(), F.lit("/"), shown(F.get("positive_messages", F.lit(0)))))
add("region_captions", {"caption": "l", "bbox": "array(id + 0.5D, 1.4D, 2.6D, 3.5D)"}, lambda df: D.region_captions(df, grounding=False), "l || '/' || CAST(round_even(id + 0.5, 0) AS BIGINT) || ',1,3,4/' || l",
    out=lambda: F.concat(F.get("objects.ref", F.lit(0)), F.lit("/"), F.array_join(F.get("objects.bbox", F.lit(0)), ","), F.lit("/"), F.element_at("messages", -1)["content"]))
add("one_question", {"questions": "if(id % 2 = 0, array(l), array())", "answers": "array(s)"}, D.one_question, "'user=' || l || '|assistant=' || s", "id % 2 = 0")
add("science_questions", {"question": "l", "solution": "s", "choices": "array('a', string(id), 'c')", "answer": "int(id % 3)"}, D.science_questions, f"'user=' || l || '|assistant=' || s || {NL} || 'So the final answer is: ' || CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN CAST(id AS VARCHAR) ELSE 'c' END")
add("grounded_captions", {"caption": "concat('a dog and cat ', id)", "ref_exps": "array(named_struct('start', 10, 'end', 13, 'box', array(0D, 1D)), named_struct('start', if(id % 3 = 0, 9, 0), 'end', if(id % 3 = 0, 11, 5), 'box', array(1D, id)))"}, D.grounded_captions,
    "'a dog,cat/1.0;' || id || '.0,0.0;1.0/norm1'", "id % 3 > 0", lambda: F.concat_ws("/", F.array_join("objects.ref", ","), F.array_join(F.transform("objects.bbox", lambda b: F.array_join(F.transform(b, lambda v: v.cast("decimal(12,1)").cast("string")), ";")), ","), "objects.bbox_type"))
add("scene_questions", {"question": "l", "fullAnswer": "concat(s, id)"}, D.scene_questions, "'user=' || l || '|assistant=' || s || id")
add("detections", {"category": "array(int(id % 3), 1)", "bbox": "array(array(1, 2), array(3, id))"}, lambda df: D.detections(df, ("dog", "cat", "cow")), "'user=Find all objects.|assistant=<ref-object><bbox><ref-object><bbox>/' || CASE id % 3 WHEN 0 THEN 'dog' WHEN 1 THEN 'cat' ELSE 'cow' END || ',cat'", out=lambda: F.concat(messages(), F.lit("/"), F.array_join("objects.ref", ",")))
add("typed_turns", {"messages": "array(named_struct('role', 'user', 'content', array(named_struct('type', 'text', 'text', l, 'url', ''), named_struct('type', 'image_url', 'text', '', 'url', s))), named_struct('role', 'assistant', 'content', array(named_struct('type', 'text', 'text', string(id), 'url', ''))))"}, D.typed_turns, "'user=' || l || '<image>|assistant=' || id")
add("counted_objects", {"problem": "concat('How many ', l, id, '?')"}, D.counted_objects, "'user=How many ' || l || id || '? Output the thinking process in <think> </think> and final answer (number) in <answer> </answer> tags.'")
add("multi_labels", {"flags": "array(int(id % 2), int(id % 3 = 0), 1)"}, D.multi_labels, "CASE WHEN id % 2 = 1 THEN '0,' ELSE '' END || CASE WHEN id % 3 = 0 THEN '1,' ELSE '' END || '2'", out=listed("label"))
add("geometry", {"query": "l", "response": "concat(s, id)"}, D.geometry, "'user=' || l || '|assistant=' || s || id || '/' || s || id", out=lambda: F.concat(messages(), F.lit("/"), F.col("solution")))
add("voices", {"audio": "if(id % 2 = 0, concat('/', l), l)", "ref_audio": "if(id % 3 = 0, null, s)"}, lambda df: D.voices(df, "dir/"), "CASE WHEN id % 2 = 0 THEN '/' ELSE 'dir/' END || l || '/' || CASE WHEN id % 3 = 0 THEN '-' ELSE 'dir/' || s END", out=lambda: F.concat(listed("audios")(), F.lit("/"), F.coalesce(listed("ref_audios")(), F.lit("-"))))
add("self_cognition", {"query": "'{{NAME}}?'", "response": "concat('{{AUTHOR}} ', id)", "tag": "if(id % 2 = 0, 'zh', 'en')"}, lambda df: P.response_messages(P.self_cognition(df, ("小", "Small"), ("作", "Author"))), "CASE WHEN id % 2 = 0 THEN 'user=小?|assistant=作 ' ELSE 'user=Small?|assistant=Author ' END || id")
add("grounding_prompts", {"ref": "l", "code": "if(id % 2 = 0, 'en', 'zh')"}, lambda df: df.withColumn("out", D.grounding_prompts("find", F.col("ref"), F.col("code"), {("find", "en"): ("Find it.",), ("find", "zh"): ("找。",), ("tell", "en"): ("Tell.",)})), "CASE WHEN id % 2 = 0 THEN 'Find it.' ELSE '找。' END", out=lambda: F.col("out"))


def listing(spark, folder: str, path: str) -> DataFrame:
    """Files of every third document."""
    return base(spark, folder).where("id % 3 = 0").select(F.expr(path).alias("path"))


@query("ds_listed_images", f"WITH {BASE} SELECT id, 'dir/' || id || CASE WHEN id % 2 = 0 THEN ',dir/' || (id + 1) ELSE '' END AS out FROM d WHERE id % 3 = 0 AND id % 2 = 1")
def listed_images(spark, folder):
    df = base(spark, folder).select("id", F.expr("if(id % 2 = 0, array(string(id), string(id + 1)), array(string(id)))").alias("images"))
    return D.listed_images(df, "dir", listing(spark, folder, "concat('dir/', id)"), "id").select("id", F.array_join("images", ",").alias("out"))


@query("ds_foldered_images", f"WITH {BASE} SELECT id, CASE WHEN id % 2 = 0 THEN 'A/' ELSE 'B/' END || CASE WHEN id % 2 = 0 THEN 'coco/' ELSE 'gqa/' END || id AS out FROM d WHERE id % 3 = 0")
def foldered_images(spark, folder):
    df = base(spark, folder).select("id", F.expr("concat(if(id % 2 = 0, 'coco/', 'gqa/'), id)").alias("image"))
    files = listing(spark, folder, "concat(if(id % 2 = 0, 'A/coco/', 'B/gqa/'), id)")
    return D.foldered_images(df, {"coco": "A/", "gqa": "B/"}, files).select("id", F.col("image").alias("out"))


@query("ds_nulled_images", f"WITH {BASE} SELECT id, CASE WHEN id % 3 = 0 THEN 'A/coco/' || id END AS out FROM d")
def nulled_images(spark, folder):
    df = base(spark, folder).select("id", F.concat(F.lit("coco/"), "id").alias("image"))
    return D.foldered_images(df, {"coco": "A/"}, listing(spark, folder, "concat('A/coco/', id)"), drop=False).select("id", F.col("image").alias("out"))
