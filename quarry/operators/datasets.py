"""Preparations of known dataset shapes, text and media: each takes the raw DataFrame and returns common columns.

Prompt texts are fixed values of the formats. Random choices are picks by a hash of the row, so they repeat.  Media are checked against a listing of files
where one is given.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import literal_to_json
from quarry.operators import preprocess as P
from quarry.operators.joins import all_existing, existing

Prepare = Callable[..., DataFrame]
PREPARATIONS: dict[str, Prepare] = {}


def preparation(f: Prepare) -> Prepare:
    PREPARATIONS[f.__name__] = f
    return f


def turns(*pairs: tuple[str, Column]) -> Column:
    return P.with_content(F.array(*[P.message(r, c) for r, c in pairs]))


def pick(options: Sequence[str], *key: Column, seed: int = 42) -> Column:
    """One of the options by a hash of the row."""
    return F.get(F.array(*[F.lit(o) for o in options]), F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(len(options))).cast("int"))


def without_prefix(text: Column, prefix: str) -> Column:
    return F.when(F.startswith(text, F.lit(prefix)), F.substring(text, F.lit(len(prefix) + 1), F.length(text))).otherwise(text)


def _as_query(df: DataFrame, query: Column, response: Column, system: Column | None = None) -> DataFrame:
    pairs = [("system", system)] if system is not None else []
    return df.withColumn("messages", turns(*pairs, ("user", query), ("assistant", response)))


@preparation
def alpaca_zh(df: DataFrame) -> DataFrame:
    return P.instruction_messages(df.withColumn("input", without_prefix(F.col("input"), "输入：")))


@preparation
def long_alpaca(df: DataFrame) -> DataFrame:
    return P.instruction_messages(df.withColumn("output", without_prefix(F.col("output"), "Answer: ")))


@preparation
def ruozhiba(df: DataFrame) -> DataFrame:
    title = F.concat(F.col("title"), F.coalesce(F.concat(F.lit("，"), F.when(F.col("abs") != "", F.col("abs"))), F.lit(""))) if "abs" in df.columns else F.col("title")
    hit = F.regexp_extract(title, r"\d+[\.,\s、](.+)", 1)
    return df.withColumn("messages", turns(("assistant", F.when(hit != "", hit).otherwise(title))))


@preparation
def math_pairs(df: DataFrame) -> DataFrame:
    return P.response_messages(df.select("query", "response"))


@preparation
def assistant_bench(df: DataFrame, default_system: str = "You are a helpful assistant.") -> DataFrame:
    """Default system turns go; rows in which a turn names moss or a role mark go."""
    m = F.filter("messages", lambda x: ~((x["role"] == "system") & (x["content"] == default_system)))
    return df.withColumn("messages", m).where(~F.exists("messages", lambda x: F.rlike(F.lower(x["content"]), F.lit("moss|human:|assistant:|user:"))))


@preparation
def multi_plugin(df: DataFrame, pattern: str = r'"name":\s*"([^"]+)"') -> DataFrame:
    """Rows whose system text names two different plugins at least."""
    system = F.get("messages", F.lit(0))["content"]
    return df.where(F.size(F.array_distinct(F.regexp_extract_all(system, F.lit(pattern), 1))) >= 2)


@preparation
def instruction_kinds(df: DataFrame, kinds: Sequence[str] = ()) -> DataFrame:
    kept = df.where(F.col("kind").isin(*kinds)) if kinds else df
    return P.response_messages(kept.select(F.col("input").alias("query"), F.col("target").alias("response")))


@preparation
def text_to_sql(df: DataFrame) -> DataFrame:
    q = F.concat(F.lit("Sql Table information:\n"), F.col("sql_context"), F.lit("\n"), F.col("sql_prompt"))
    r = F.concat(F.lit("Let's think step by step:\n"), F.col("sql_explanation"), F.lit("\nSo the final sql is:\n"), F.col("sql"))
    return _as_query(df, q, r)


@preparation
def tool_conversations(df: DataFrame) -> DataFrame:
    """Conversations of exactly two turns; other speakers than the user are the assistant."""
    m = F.transform("messages", lambda x: F.struct(F.when(x["role"].isin("caller", "conclusion"), "assistant").otherwise(x["role"]).alias("role"), x["content"].alias("content")))
    return df.where(F.size("messages") == 2).withColumn("messages", m)


@preparation
def math_with_answer(df: DataFrame) -> DataFrame:
    return _as_query(df, F.col("input"), F.concat(F.col("output"), F.lit("\n\nAnswer: "), F.col("answer")))


@preparation
def law_chapters(df: DataFrame) -> DataFrame:
    parts = F.concat_ws("\n", "type", "title", *[F.when(F.col(c) != "", F.col(c)) for c in ("chapter1", "chapter2", "chapter3")], "response")
    return df.withColumn("messages", turns(("assistant", parts)))


@preparation
def code_problems(df: DataFrame) -> DataFrame:
    """The text before the first Python fence asks, the rest answers."""
    text = F.col("code_with_problem")
    at = F.instr(text, "```python")
    problem = F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(F.substring(text, F.lit(1), F.length(text) - 1))
    q = F.regexp_replace(problem, r"^# ", "")
    r = F.concat(F.when(at > 0, F.substring(text, at, F.length(text))).otherwise(F.substring(text, F.length(text), F.lit(1))), F.lit("\n\n"), F.col("explanation_only"))
    return _as_query(df, q, r)


@preparation
def sentence_pairs(df: DataFrame, threshold: float | None = None) -> DataFrame:
    out = df if threshold is None else df.where(F.col("score") >= threshold)
    one = lambda c: F.array(P.message("user", F.col(c)))
    return out.withColumns({"messages": one("sentence1"), "positive_messages": F.array(one("sentence2")), "label": F.col("score").cast("double")})


@preparation
def sentence_scores(df: DataFrame, generate: bool = True) -> DataFrame:
    q = F.concat(F.lit("Task: Based on the given two sentences, provide a similarity score between 0.0 and 5.0.\nSentence 1: "), F.col("sentence1"), F.lit("\nSentence 2: "), F.col("sentence2"), F.lit("\nSimilarity score: "))
    if generate:
        return _as_query(df, q, F.format_string("%.1f", F.col("score").cast("double")))
    return df.withColumns({"messages": turns(("user", q)), "label": F.col("score").cast("double")})


@preparation
def rerank_lists(df: DataFrame) -> DataFrame:
    each = lambda c: F.transform(c, lambda t: F.array(P.message("assistant", t)))
    return df.withColumns({"messages": turns(("user", F.col("query"))), "positive_messages": each("positive"), "negative_messages": each("negative")})


@preparation
def literal_conversations(df: DataFrame, column: str = "conversations") -> DataFrame:
    """Conversations written as Python literals, commas between turns missing."""
    rows = F.from_json(literal_to_json(F.col(column)), "array<map<string,string>>")
    first = lambda m, *names: F.coalesce(*[F.try_element_at(m, F.lit(n)) for n in names])
    out = F.transform(rows, lambda m: F.struct(P.canonical_role(first(m, "role", "from")).alias("role"), first(m, "content", "value").alias("content")))
    return df.withColumn("messages", F.when(F.size(out) > 0, out)).where(F.col("messages").isNotNull())


@preparation
def chat_rooms(df: DataFrame) -> DataFrame:
    """The room's history is told in the system text; rows without a query go."""
    system = F.concat_ws("\n\n", F.col("system"), F.concat(F.lit("Chat history:\n"), F.array_join(F.transform("history", lambda h: F.concat_ws(": ", h)), "\n")))
    return _as_query(df.where(F.col("query") != ""), F.col("query"), F.col("response"), system)


@preparation
def countdown(df: DataFrame) -> DataFrame:
    q = F.concat(F.lit("Using the numbers ["), F.array_join(F.transform("nums", lambda n: n.cast("string")), ", "), F.lit("], create an equation that equals "), F.col("target").cast("string"), F.lit(".\nYou can use basic arithmetic operations (+, -, *, /) and each number can only be used once. Show your work in <think> </think> tags. And return the final equation and answer in <answer> </answer> tags, for example <answer> (1 + 2) / 3 * 4 = 4 </answer>."))
    return df.withColumn("messages", turns(("user", q)))


@preparation
def human_or_model(df: DataFrame, classify: bool = False) -> DataFrame:
    """Two rows a question: a human's and a model's answer, each picked by hash."""
    choose = lambda c: F.get(c, F.pmod(F.xxhash64("question", F.lit(c)), F.greatest(F.size(c), F.lit(1))).cast("int"))
    two = df.select("question", F.explode(F.array(F.struct(F.lit(0).alias("label"), F.lit("Human").alias("who"), choose("human_answers").alias("answer")), F.struct(F.lit(1).alias("label"), F.lit("ChatGPT").alias("who"), choose("chatgpt_answers").alias("answer")))).alias("x")).select("question", "x.*").where(F.col("answer").isNotNull())
    q = F.concat(F.lit("Classification Task: Are the following responses from a human or from ChatGPT?\nQuestion: "), F.col("question"), F.lit("\nAnswer: "), F.col("answer"), F.lit("\nCategory: Human, ChatGPT\nOutput:"))
    if classify:
        return two.select(turns(("user", q)).alias("messages"), "label")
    return two.select(turns(("user", q), ("assistant", F.col("who"))).alias("messages"))


@preparation
def context_questions(df: DataFrame) -> DataFrame:
    """'answer [SEP] context' asks for the question."""
    parts = F.split("text1", r"\[SEP\]")
    q = F.concat(F.lit("Task: Question Generation\nContext: "), F.get(parts, F.lit(1)), F.lit("\nAnswer: "), F.get(parts, F.lit(0)), F.lit("\nQuestion:"))
    return _as_query(df.where(F.size(parts) == 2), q, F.col("text2"))


@preparation
def preference_dialogues(df: DataFrame) -> DataFrame:
    """Marked dialogues: the turns of `chosen`, and the last answer of `rejected`."""
    split = lambda c: F.filter(F.transform(F.split(c, r"\n\nHuman:|\n\nAssistant:|\n\nHum:"), lambda t: F.trim(t)), lambda t: t != "")
    role = lambda i: F.when(i % 2 == 0, "user").otherwise("assistant")
    m = F.transform(split("chosen"), lambda t, i: F.struct(role(i).alias("role"), t.alias("content")))
    return df.withColumns({"messages": m, "rejected_response": F.element_at(split("rejected"), -1)})


@preparation
def function_answers(df: DataFrame, text: bool = False) -> DataFrame:
    """JSON answers as tool_call turns, or as Action text."""
    calls = F.from_json("answers", "array<struct<name:string,arguments:map<string,string>>>")
    if text:
        r = F.array_join(F.transform(calls, lambda c: F.concat(F.lit("Action: "), c["name"], F.lit("\nAction Input: "), F.to_json(c["arguments"]))), "\n")
        return df.withColumns({"messages": turns(("user", F.col("query"))), "solution": r})
    return df.withColumn("messages", F.concat(F.array(P.message("user", F.col("query"))), F.transform(calls, lambda c: P.message("tool_call", F.to_json(c)))))


@preparation
def preference_history(df: DataFrame) -> DataFrame:
    m = F.concat(F.transform("context", lambda x: F.struct(P.canonical_role(x["role"]).alias("role"), x["text"].alias("content"))), F.array(P.message("assistant", F.col("chosen.text"))))
    return df.withColumns({"messages": m, "rejected_response": F.col("rejected.text")})


@preparation
def emoji_free(df: DataFrame) -> DataFrame:
    return P.auto_preprocess(df.withColumns({c: F.replace(F.col(c), F.lit("️"), F.lit("")) for c, t in df.dtypes if t == "string"}))


@preparation
def delimited_chat(df: DataFrame, marks: Sequence[str] = ("User:", "Assistant:")) -> DataFrame:
    """Turns that alternate between marks of user and assistant; others are malformed and go."""
    text = F.col("input")
    split = F.filter(F.transform(F.split(text, "|".join(marks)), lambda t: F.trim(t)), lambda t: t != "")
    keys = F.regexp_extract_all(text, F.lit("(" + "|".join(marks) + ")"), 1)
    fine = F.forall(F.transform(keys, lambda k, i: k == F.when(i % 2 == 0, marks[0]).otherwise(marks[1])), lambda x: x) & (F.size(keys) == F.size(split))
    m = F.transform(split, lambda t, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), t.alias("content")))
    return df.where(fine).withColumn("messages", F.concat(m, F.array(P.message("assistant", F.col("output")))))


@preparation
def described_functions(df: DataFrame) -> DataFrame:
    return df.withColumns({"tools": F.filter(F.split("functions_description", "\n\n"), lambda t: t != ""), "messages": F.filter("messages", lambda m: m["role"] != "system")})


@preparation
def context_instructions(df: DataFrame) -> DataFrame:
    context = F.when(F.col("context") != "", F.concat(F.lit("Here gives some useful information:\n"), F.col("context"), F.lit("\n"))).otherwise(F.lit(""))
    return _as_query(df, F.concat(F.coalesce(context, F.lit("")), F.col("instruction")), F.col("response"))


@preparation
def preference_mix(df: DataFrame, dropped: str = "toxic-dpo-v0.2") -> DataFrame:
    return df.where(F.coalesce(F.col("source"), F.lit("")) != dropped)


@preparation
def sudoku(df: DataFrame) -> DataFrame:
    board = lambda c: F.regexp_replace(F.replace(F.col(c), F.lit("."), F.lit("0")), "(.{9})(?=.)", "$1\n")
    return _as_query(df, F.concat(F.lit("Solve the sudoku puzzle:\n"), board("puzzle")), board("solution"))


# Media.


def placed(df: DataFrame, column: str, folder: str, listing: DataFrame | None = None) -> DataFrame:
    """Put a folder before a relative path and keep rows whose file is listed."""
    out = df.withColumn(column, F.concat(F.lit(folder.rstrip("/") + "/"), F.col(column)))
    return out if listing is None else existing(out, listing, column)


@preparation
def constant_query(df: DataFrame, query: str = "Describe the picture.") -> DataFrame:
    return P.response_messages(df.withColumn("query", F.lit(query)))


@preparation
def captions(df: DataFrame, prompts: Sequence[str] = ("What is in the picture?", "Describe the picture.", "What does the picture show?"), column: str = "caption") -> DataFrame:
    """A picked prompt; the caption up to the first && without its lead-in."""
    text = without_prefix(F.substring_index(F.col(column), "&&", 1), "This image displays:")
    return _as_query(df, pick(prompts, F.col(column)), F.trim(text))


@preparation
def dense_captions(df: DataFrame) -> DataFrame:
    text = F.get_json_object(literal_to_json(F.col("cap_seg")), "$.global_caption")
    return _as_query(df.where(text.isNotNull()), F.lit("Describe the picture."), text)


@preparation
def listed_images(df: DataFrame, folder: str, listing: DataFrame, row: str) -> DataFrame:
    """All images of a row have to be listed."""
    out = df.withColumn("images", F.transform("images", lambda i: F.concat(F.lit(folder.rstrip("/") + "/"), i)))
    return all_existing(out, listing, "images", row)


@preparation
def foldered_images(df: DataFrame, folders: dict[str, str], listing: DataFrame | None = None, drop: bool = True) -> DataFrame:
    """The folder of the first part that the path contains; files not listed drop the row, or the image only."""
    case = F.col("image")
    for part, folder in reversed(folders.items()):
        case = F.when(F.contains(F.col("image"), F.lit(part)), F.concat(F.lit(folder), F.col("image"))).otherwise(case)
    out = df.withColumn("image", case)
    if listing is None:
        return out
    if drop:
        return existing(out, listing, "image")
    seen = listing.select(F.col("path").alias("image"), F.lit(True).alias("__seen")).distinct()
    return out.join(seen, "image", "left").withColumn("image", F.when(F.col("__seen"), F.col("image"))).drop("__seen")


@preparation
def speech(df: DataFrame) -> DataFrame:
    return _as_query(df, F.lit("Transcribe the speech."), F.replace(F.col("text"), F.lit(" "), F.lit("")))


@preparation
def video_options(df: DataFrame, classify: bool = False, listing: DataFrame | None = None) -> DataFrame:
    """Options by letter under the question; the answer is the letter, or its number."""
    out = df if listing is None else existing(df, listing, "video")
    options = F.array_join(F.transform("options", lambda o, i: F.concat(F.char(F.lit(65) + i), F.lit(". "), o)), "\n")
    q = F.concat(F.col("question"), F.lit("\n"), options)
    if classify:
        return out.withColumns({"messages": turns(("user", q)), "label": F.col("answer").cast("int")})
    return _as_query(out, q, F.char(F.lit(65) + F.col("answer").cast("int")))


@preparation
def first_video_question(df: DataFrame) -> DataFrame:
    one = F.get("global", F.lit(0))
    return _as_query(df.where(one.isNotNull()), one["question"], one["answer"])


@preparation
def any_video_question(df: DataFrame) -> DataFrame:
    given = lambda c: F.when(F.col(c) != "None", F.col(c))
    return _as_query(df, F.coalesce(given("query"), given("question_1"), given("question_2")), F.col("response"))


@preparation
def action_sessions(df: DataFrame, order: str, session: str | None = None) -> DataFrame:
    """A row with target_action_index '0' begins a conversation; the rows up to the next one belong to it."""
    from pyspark.sql import Window

    w = (Window.partitionBy(session) if session else Window.partitionBy(F.lit(1))).orderBy(order)
    numbered = df.withColumn("conv", F.sum((F.col("target_action_index") == "0").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("conv > 0")
    keys = [*([session] if session else []), "conv"]
    action = F.concat(F.trim(F.substring_index(F.substring_index("action", "->", -1), ":", 1)), F.lit(" "), F.trim(F.substring_index("action", ":", -1)))
    rows = numbered.withColumn("__a", action)
    g = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("__a").alias("a"), F.col("task").alias("task")))).alias("s"))
    m = F.flatten(F.transform("s", lambda x, i: F.array(P.message("user", F.when(i == 0, F.concat(x["task"], F.lit("\nWhat is the next step?"))).otherwise(F.lit("What is the next step?"))), P.message("assistant", x["a"]))))
    return g.select(*keys, m.alias("messages"))


@preparation
def caption_pairs(df: DataFrame) -> DataFrame:
    return df.withColumns({"messages": turns(("user", F.lit("<image>"))), "positive_messages": F.array(turns(("user", F.get("captions", F.lit(0)))))})


@preparation
def caption_ranking(df: DataFrame, row: str, negatives: int = 7) -> DataFrame:
    """Positives are the row's captions, negatives come from the pool of all rows without them."""
    from quarry.operators.sampling import negatives as drawn

    pool = df.select(F.explode("captions").alias("caption"))
    neg = drawn(df, pool, row, "captions", "caption", negatives).groupBy(row).agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "negative"))), lambda x: x["negative"]).alias("negatives"))
    return df.join(neg, row, "left")


@preparation
def region_captions(df: DataFrame, grounding: bool = True) -> DataFrame:
    """A region's box, rounded, with its caption."""
    box = F.transform("bbox", lambda v: F.bround(v, 0).cast("int"))
    q = pick(("Where is <ref-object>?", "Locate <ref-object>.") if grounding else ("What is in <bbox>?", "Describe <bbox>."), F.col("caption"))
    out = _as_query(df, q, F.lit("<bbox>") if grounding else F.col("caption"))
    return out.withColumn("objects", F.struct(F.array("caption").alias("ref"), F.array(box).alias("bbox")))


@preparation
def one_question(df: DataFrame) -> DataFrame:
    i = F.pmod(F.xxhash64("questions"), F.greatest(F.size("questions"), F.lit(1))).cast("int")
    return _as_query(df.where(F.size("questions") > 0), F.get("questions", i), F.get("answers", i))


@preparation
def science_questions(df: DataFrame) -> DataFrame:
    return _as_query(df, F.col("question"), F.concat(F.col("solution"), F.lit("\nSo the final answer is: "), F.get("choices", F.col("answer").cast("int"))))


@preparation
def grounded_captions(df: DataFrame) -> DataFrame:
    """Spans (start, end, box) of a caption, in order; rows with overlapping or no spans go."""
    s = F.array_sort(F.transform("ref_exps", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["box"].alias("box"))))
    out = df.withColumn("__s", s).where(F.size("__s") > 0)
    overlap = F.exists(F.sequence(F.lit(1), F.greatest(F.size("__s") - 1, F.lit(1))), lambda i: F.coalesce(F.get("__s", i)["start"] < F.get("__s", i - 1)["end"], F.lit(False)))
    return out.where(~overlap).withColumn("objects", F.struct(F.transform("__s", lambda x: F.substring(F.col("caption"), x["start"] + 1, x["end"] - x["start"])).alias("ref"), F.transform("__s", lambda x: x["box"]).alias("bbox"), F.lit("norm1").alias("bbox_type"))).drop("__s")


@preparation
def scene_questions(df: DataFrame) -> DataFrame:
    return _as_query(df, F.col("question"), F.col("fullAnswer"))


@preparation
def detections(df: DataFrame, names: Sequence[str]) -> DataFrame:
    ref = F.transform("category", lambda c: F.get(F.array(*[F.lit(n) for n in names]), c.cast("int")))
    r = F.array_join(F.array_repeat(F.lit("<ref-object><bbox>"), F.size("bbox")), "")
    return _as_query(df, F.lit("Find all objects."), r).withColumn("objects", F.struct(ref.alias("ref"), F.col("bbox")))


@preparation
def typed_turns(df: DataFrame) -> DataFrame:
    m = F.transform("messages", lambda x: F.struct(x["role"].alias("role"), P.flatten_typed_content(x["content"])["text"].alias("content")))
    return df.withColumn("messages", m)


@preparation
def counted_objects(df: DataFrame) -> DataFrame:
    return df.withColumn("messages", turns(("user", F.concat(F.col("problem"), F.lit(" Output the thinking process in <think> </think> and final answer (number) in <answer> </answer> tags.")))))


@preparation
def multi_labels(df: DataFrame) -> DataFrame:
    hit = F.filter(F.transform("flags", lambda v, i: F.when(v == 1, i)), lambda i: i.isNotNull())
    return df.withColumns({"messages": turns(("user", F.lit("<image>"))), "label": hit})


@preparation
def geometry(df: DataFrame) -> DataFrame:
    return P.response_messages(df.withColumn("solution", F.col("response")))


@preparation
def voices(df: DataFrame, folder: str) -> DataFrame:
    absolute = lambda c: F.when(F.startswith(c, F.lit("/")), c).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), c))
    return df.withColumns({"audios": F.array(absolute(F.col("audio"))), "ref_audios": F.when(F.col("ref_audio").isNotNull(), F.array(absolute(F.col("ref_audio"))))})


def grounding_prompts(task: str, ref: Column, lang: Column, prompts: dict[tuple[str, str], Sequence[str]]) -> Column:
    """A picked prompt of a task and language."""
    out = F.lit(None).cast("string")
    for (t, code), options in prompts.items():
        if t == task:
            out = F.when(lang == code, pick(options, ref)).otherwise(out)
    return out
