"""Chat templates: conversations to segments, tokens, labels and weights, all in column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.arrays import let, pad
from quarry.functions.text import fill_placeholders, parts_of
from quarry.operators.preprocess import MESSAGES, message

IGNORED = -100
SEGMENTS = "array<struct<text:string,kind:string,weight:double>>"


@dataclass(frozen=True)
class Template:
    """Texts around the turns; {{SYSTEM}}, {{QUERY}}, {{ROUND0}} and {{ROUND1}} are placeholders."""

    name: str
    prompt: str
    prefix: str = ""
    chat_sep: str | None = ""
    suffix: str = ""
    system_prefix: str | None = None
    default_system: str | None = None
    stop_words: tuple[str, ...] = ()
    thinking_prefix: str = ""

    @property
    def multi_round(self) -> bool:
        return self.chat_sep is not None


#: Public chat formats.
TEMPLATES: dict[str, Template] = {
    t.name: t
    for t in (
        Template("chatml", "<|im_start|>user\n{{QUERY}}<|im_end|>\n<|im_start|>assistant\n", chat_sep="<|im_end|>\n", suffix="<|im_end|>", system_prefix="<|im_start|>system\n{{SYSTEM}}<|im_end|>\n", default_system="You are a helpful assistant."),
        Template("default", "### Human:\n{{QUERY}}\n\n### Assistant:\n", chat_sep="\n\n", system_prefix="{{SYSTEM}}\n\n"),
        Template("llama2", "[INST] {{QUERY}} [/INST]", prefix="<s>", chat_sep=" </s><s>", suffix="</s>", system_prefix="<s>[INST] <<SYS>>\n{{SYSTEM}}\n<</SYS>>\n\n[/INST]"),
        Template("zephyr", "<|user|>\n{{QUERY}}</s>\n<|assistant|>\n", chat_sep="</s>\n", suffix="</s>", system_prefix="<|system|>\n{{SYSTEM}}</s>\n"),
        Template("generation", "{{QUERY}}", chat_sep=None, suffix="<|endoftext|>"),
    )
}


def register_template(template: Template, exist_ok: bool = False) -> None:
    if template.name in TEMPLATES and not exist_ok:
        raise ValueError(f"template {template.name} is already registered")
    if template.system_prefix is None and "{{SYSTEM}}" in template.prefix:
        template = replace(template, system_prefix=template.prefix, prefix=re.sub(r"\{\{SYSTEM\}\}", "", template.prefix))
    TEMPLATES[template.name] = template


def merged_turns(messages: Column) -> Column:
    """Neighbouring turns of one role become one: texts are joined, of the assistant's too."""
    start = F.array().cast(MESSAGES)

    def step(acc: Column, m: Column) -> Column:
        last = F.element_at(acc, -1)
        fresh = F.struct(m["role"].alias("role"), m["content"].alias("content"))
        joined = F.struct(last["role"].alias("role"), F.concat(last["content"], m["content"]).alias("content"))
        return F.when((F.size(acc) > 0) & (last["role"] == m["role"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(fresh)))

    return F.aggregate(messages, start, step)


def tool_turns(messages: Column) -> Column:
    """Runs of tool calls are an assistant's turn, runs of tool results a user's."""
    role = lambda r: F.when(r == "tool_call", "assistant").when(r.isin("tool", "tool_response"), "user").otherwise(r)
    return merged_turns(F.transform(messages, lambda m: F.struct(role(m["role"]).alias("role"), m["content"].alias("content"))))


def standard_turns(messages: Column) -> Column:
    """Without system; an empty user before a leading assistant, and a null assistant at an odd end."""
    turns = F.filter(messages, lambda m: m["role"] != "system")
    led = F.when(F.get(turns, F.lit(0))["role"] == "assistant", F.concat(F.array(message("user", F.lit(""))), turns)).otherwise(turns)
    return F.when(F.size(led) % 2 == 1, F.concat(led, F.array(message("assistant", F.lit(None).cast("string"))))).otherwise(led)


def system_of(messages: Column, default: str | None = None, tools: Column | None = None) -> Column:
    """The row's system text, else the default; tool descriptions follow it."""
    own = F.get(F.filter(messages, lambda m: m["role"] == "system"), F.lit(0))["content"]
    system = F.coalesce(own, F.lit(default).cast("string"))
    return system if tools is None else F.when(tools.isNull(), system).otherwise(F.concat_ws("\n\n", system, tools))


def segments(messages: Column, template: Template, training: bool = True, strategy: str = "default", tools: Column | None = None) -> Column:
    """array<struct<text, kind, weight>> of a conversation.

    strategy: 'default' weighs responses and the suffix, 'last_round' only the last of them, 'all' everything.
    Only single-round templates keep nothing but the last round.
    """
    if strategy not in ("default", "last_round", "all"):
        raise ValueError(strategy)
    turns = standard_turns(tool_turns(messages))
    if not template.multi_round:
        turns = F.slice(turns, F.greatest(F.size(turns) - 1, F.lit(1)), 2)
    system = system_of(messages, template.default_system, tools)
    seg = lambda text, kind, weight: F.struct(text.alias("text"), F.lit(kind).alias("kind"), weight.cast("double").alias("weight"))
    base = F.lit(1.0 if strategy == "all" else 0.0)
    head = F.when(system.isNull() | F.lit(template.system_prefix is None), F.lit(template.prefix)).otherwise(fill_placeholders(F.lit(template.system_prefix or ""), {"SYSTEM": system}))

    def rounds(t: Column) -> Column:
        n = (F.size(t) / 2).cast("int")

        def one(i: Column) -> Column:
            query, response = F.get(t, 2 * i)["content"], F.get(t, 2 * i + 1)["content"]
            last = i == n - 1
            ask = fill_placeholders(F.lit(template.prompt), {"QUERY": query, "ROUND0": i, "ROUND1": i + 1})
            weight = F.lit(1.0) if strategy != "last_round" else F.when(last, 1.0).otherwise(0.0)
            ends = F.lit(False)
            for w in template.stop_words:
                ends = ends | F.endswith(F.coalesce(response, F.lit("")), F.lit(w))
            close = F.when(last & response.isNotNull() & F.lit(training) & ~ends, F.lit(template.suffix)).otherwise(F.lit(""))
            sep = F.when(last, F.lit("")).otherwise(F.lit(template.chat_sep or ""))
            return F.array(seg(ask, "prompt", base), seg(F.coalesce(response, F.lit("")), "response", weight), seg(sep, "separator", base), seg(close, "suffix", weight))

        at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(at, one)).cast(SEGMENTS)

    body = F.element_at(F.transform(F.array(turns), rounds), 1)
    return F.filter(F.concat(F.array(seg(head, "prefix", base)), body), lambda s: s["text"] != "")


def message_weights(segs: Column, weights: Column) -> Column:
    """Override the weights of responses by an array of doubles, one for each response; null elements keep theirs."""
    start = F.struct(F.lit(0).alias("i"), F.array().cast(SEGMENTS).alias("out"))

    def step(acc: Column, s: Column) -> Column:
        is_response = s["kind"] == "response"
        w = F.when(is_response, F.coalesce(F.get(weights, acc["i"]), s["weight"])).otherwise(s["weight"])
        return F.struct((acc["i"] + F.when(is_response, 1).otherwise(0)).alias("i"), F.concat(acc["out"], F.array(F.struct(s["text"].alias("text"), s["kind"].alias("kind"), w.alias("weight")))).alias("out"))

    return F.aggregate(segs, start, step, lambda acc: acc["out"])


def simplified(segs: Column) -> Column:
    """Neighbouring segments of equal weight become one."""

    def step(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(F.concat(last["text"], s["text"]).alias("text"), last["kind"].alias("kind"), last["weight"].alias("weight"))
        return F.when((F.size(acc) > 0) & (last["weight"] == s["weight"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(segs, F.array().cast(SEGMENTS), step)


#: Weights of the marks in responses, by pattern (one weight) or delimiter (mark and what follows).
#: Entries of three numbers are neither, and weigh nothing.
LOSS_SCALES: dict[str, dict[str, list[float]]] = {
    "react": {"Action:": [2.0, 2.0], "Action Input:": [2.0, 2.0], "Thought:": [1.0, 1.0], "Final Answer:": [1.0, 1.0], "Observation:": [2.0, 0.0]},
    "alpha_umi": {"Action:": [2.0, 2.0], "Action Input:": [2.0, 2.0], "Thought:": [1.0, 1.0], "Final Answer:": [1.0, 1.0], "Observation:": [2.0, 0.0], "Next:": [2, 0, 2.0]},
    "agentflan": {
        "Name:": [1.0, 3.0], "Action:": [1.0, 3.0], "ACTION:": [1.0, 3.0], "Tool:": [1.0, 3.0], "Command": [1.0, 3.0], "Arguments:": [1.0, 3.0], "action input": [1.0, 3.0],
        "ACTION_INPUT:": [1.0, 3.0], "Action Input:": [1.0, 3.0], "Thought:": [1.0, 1.0], "Final Answer:": [1.0, 1.0], "Observation:": [2.0, 0.0],
    },
    "qwen": {"✿FUNCTION✿:": [2.0, 2.0], "✿ARGS✿:": [2.0, 2.0], "✿RETURN✿:": [1.0, 1.0], "✿RESULT✿:": [2.0, 0.0]},
    "hermes": {"<tool_call>.+?</tool_call>": [2.0]},
    "ignore_empty_think": {
        r"^<think>\s*</think>\s*": [0.0],
        r"^<seed:think><seed:cot_budget_reflect>The current thinking budget is 0, so I will directly start answering the question.</seed:cot_budget_reflect>\n</seed:think>\s*": [0.0],
        r"^</think>\s*": [0.0],
        r"^<\|channel>thought\n<channel\|>": [0.0],
        r"^</mm:think>\s*": [0.0],
    },
}
#: Texts in a query that set the weight of the whole response.
QUERY_SCALES: dict[str, dict[str, float]] = {
    "agentflan": {"What is the tool you want to use": 3.0, "What are the required parameter names": 3.0, "What is the value of": 3.0, "What are the required parameter names for this tool": 3.0},
}


def scaled_parts(text: str, scale: dict[str, list[float]], weight: float = 1.0) -> list[tuple[str, float]]:
    """(part, weight) of a response: delimiters weigh their first number and what follows the second; patterns weigh themselves."""
    delimiters = {k: v for k, v in scale.items() if len(v) == 2}
    patterns = {k: v[0] for k, v in scale.items() if len(v) == 1}
    out: list[tuple[str, float]] = []
    if delimiters:
        for part in parts_of(text, sorted(delimiters, key=len, reverse=True)):
            mark, after = delimiters.get(part["key"], [1.0, 1.0])
            out += [(t, w * weight) for t, w in ((part["key"], mark), (part["content"], after)) if t]
    elif patterns:
        out = [(p["content"], patterns.get(p["key"], 1.0) * weight) for p in parts_of(text, list(patterns), regex=True)]
    else:
        out = [(text, weight)]
    return out


def scale_responses(segs: Column, *names: str) -> Column:
    """Split responses by the named scales, one after the other; weights multiply."""
    from pyspark.sql.types import _parse_datatype_string

    scales = [(LOSS_SCALES[n], QUERY_SCALES.get(n, {})) for n in names]

    @F.pandas_udf(_parse_datatype_string(SEGMENTS))
    def run(rows: pd.Series) -> pd.Series:
        def one(segs):
            out, query = [], ""
            for s in segs:
                parts = [(s["text"], s["weight"])]
                if s["kind"] == "prompt":
                    query = s["text"]
                if s["kind"] == "response":
                    for scale, asked in scales:
                        whole = next((w for k, w in asked.items() if k in query), None)
                        parts = [x for t, w in parts for x in ([(t, w * whole)] if whole is not None else scaled_parts(t, scale, w))]
                out += [{"text": t, "kind": s["kind"], "weight": w} for t, w in parts]
            return out

        return rows.map(one)

    return run(segs)


def code_points(text: Column) -> Column:
    """The stand-in tokenizer: one token for each code point."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))


def encode(segs: Column, tokenize: Callable[[Column], Column] = code_points) -> Column:
    """struct(input_ids, labels, loss_scale, length): labels are -100 where the weight is 0, and at the first token."""
    parts = F.transform(segs, lambda s: F.struct(tokenize(s["text"]).alias("ids"), s["weight"].alias("weight")))
    ids = F.flatten(F.transform(parts, lambda p: p["ids"]))
    labels = F.flatten(F.transform(parts, lambda p: F.transform(p["ids"], lambda t: F.when(p["weight"] > 0, t).otherwise(F.lit(IGNORED)))))
    scale = F.flatten(F.transform(parts, lambda p: F.transform(p["ids"], lambda t: p["weight"])))
    binary = F.forall(segs, lambda s: s["weight"].isin(0.0, 1.0))
    first = lambda x, v: F.transform(x, lambda e, i: F.when(i == 0, F.lit(v)).otherwise(e))
    return F.struct(ids.alias("input_ids"), first(labels, IGNORED).alias("labels"), F.when(~binary, first(scale, 0.0)).alias("loss_scale"), F.size(ids).alias("length"))


def dynamic_eos(labels: Column, ids: Column, suffix: Sequence[int]) -> Column:
    """Unmask a suffix that directly follows a labelled token."""
    mark, n = F.array(*[F.lit(x) for x in suffix]), len(suffix)
    starts = F.filter(F.sequence(F.lit(1), F.size(ids) - n), lambda i: (F.slice(ids, i + 1, n) == mark) & (F.get(labels, i - 1) != IGNORED))
    inside = lambda i: F.exists(starts, lambda s: (i >= s) & (i < s + n))
    return F.when(F.size(ids) > n, F.transform(labels, lambda x, i: F.when(inside(i), F.get(ids, i)).otherwise(x))).otherwise(labels)


def truncate(df: DataFrame, max_length: int, strategy: str, protected: Sequence[int] = (), ids: str = "input_ids", labels: str = "labels") -> DataFrame:
    """delete drops long rows, raise fails on them, left and right cut them (protected tokens stay), split makes more rows."""
    n = F.size(ids)
    if strategy == "delete":
        return df.where(n <= max_length)
    if strategy == "raise":
        return df.where(F.when(n <= max_length, True).otherwise(F.raise_error(F.lit("a row is longer than max_length")).cast("boolean")))
    first = lambda x: F.transform(x, lambda e, i: F.when(i == 0, F.lit(IGNORED)).otherwise(e))
    if strategy == "split":
        at = F.explode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(max_length)))
        return df.withColumn("begin", at).withColumns({ids: F.slice(ids, F.col("begin") + 1, max_length), labels: first(F.slice(labels, F.col("begin") + 1, max_length))})
    if strategy not in ("left", "right"):
        raise ValueError(strategy)
    stays = F.transform(F.col(ids), lambda t: t.isin(*protected) if protected else F.lit(False))
    room = F.lit(max_length) - F.size(F.filter(stays, lambda s: s))
    # Tokens are taken from the side that is kept: protected ones, and free ones while there is room.
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<struct<t:int,l:int>>").alias("out"))

    def step(acc: Column, z: Column) -> Column:
        free = ~z["s"]
        take = z["s"] | (acc["n"] < z["room"])
        one = F.array(F.struct(z["t"].cast("int").alias("t"), z["l"].cast("int").alias("l")))
        return F.struct((acc["n"] + F.when(free, 1).otherwise(0)).alias("n"), F.when(take, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    if not protected:
        cut_ids, cut_labels = (F.slice(F.col(c), -max_length if strategy == "left" else 1, max_length) for c in (ids, labels))
    else:
        zipped = F.transform(F.arrays_zip(F.col(ids).alias("t"), F.col(labels).alias("l")), lambda z: F.struct(z["t"].alias("t"), z["l"].alias("l"), z["t"].isin(*protected).alias("s")))
        with_room = let(room, lambda k: F.transform(zipped, lambda z: F.struct(z["t"].alias("t"), z["l"].alias("l"), z["s"].alias("s"), k.alias("room"))))
        kept = F.aggregate(F.reverse(with_room) if strategy == "left" else with_room, start, step, lambda acc: acc["out"])
        df = df.withColumn("__kept", F.reverse(kept) if strategy == "left" else kept)
        cut_ids, cut_labels = F.transform("__kept", lambda z: z["t"]), F.transform("__kept", lambda z: z["l"])
    long = n > max_length
    return df.withColumns({ids: F.when(long, cut_ids).otherwise(F.col(ids)), labels: F.when(long, first(cut_labels)).otherwise(F.col(labels))}).drop("__kept")


def lengths(df: DataFrame) -> Column:
    """All columns whose names end in `length`, as one array."""
    return F.array(*[F.col(c).cast("int") for c in df.columns if c.endswith("length")])


def collate(df: DataFrame, batch: str, pad_id: int = 0, left: bool = False, multiple: int = 1, ids: str = "input_ids", labels: str = "labels") -> DataFrame:
    """Pad ids, labels and an attention mask to the longest row of each batch, rounded up to a multiple."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    wide = df.withColumn("__to", (F.ceil(longest / multiple) * multiple).cast("int"))
    mask = pad(F.transform(ids, lambda _: F.lit(1)), F.col("__to"), 0, left)
    return wide.withColumn("attention_mask", mask).withColumns({ids: pad(F.col(ids), F.col("__to"), pad_id, left), labels: pad(F.col(labels), F.col("__to"), IGNORED, left)}).drop("__to")


def preference_pairs(df: DataFrame, template: Template, messages: str = "messages", rejected: str = "rejected_messages") -> DataFrame:
    """chosen_ and rejected_ ids, labels and lengths of each row."""
    out = df.withColumns({"__c": encode(segments(F.col(messages), template)), "__r": encode(segments(F.col(rejected), template))})
    cols = {f"{p}_{f}": F.col(f"{c}.{f}") for p, c in (("chosen", "__c"), ("rejected", "__r")) for f in ("input_ids", "labels", "length")}
    return out.withColumns(cols).drop("__c", "__r")


def stacked_pairs(df: DataFrame, batch: str, row: str) -> DataFrame:
    """Per batch all chosen rows, then all rejected ones: (batch, position, side, input_ids, labels)."""
    one = lambda p, i: df.select(batch, row, F.lit(i).alias("half"), F.lit(p).alias("side"), F.col(f"{p}_input_ids").alias("input_ids"), F.col(f"{p}_labels").alias("labels"))
    both = one("chosen", 0).unionByName(one("rejected", 1))
    return both.withColumn("position", F.row_number().over(Window.partitionBy(batch).orderBy("half", row)) - 1).drop("half")


def embedding_rows(df: DataFrame, row: str) -> DataFrame:
    """(row, position, kind, text, label): anchor, positive, then negatives; the label is the score, 0 for negatives."""
    items = F.concat(F.array(F.struct(F.lit("anchor").alias("kind"), F.col("anchor").alias("text"), F.lit(None).cast("double").alias("label")), F.struct(F.lit("positive").alias("kind"), F.col("positive").alias("text"), F.col("score").cast("double").alias("label"))), F.transform("negatives", lambda t: F.struct(F.lit("negative").alias("kind"), t.alias("text"), F.lit(0.0).alias("label"))))
    return df.select(row, F.posexplode(items).alias("position", "item")).select(row, "position", "item.*")


def reranker_rows(df: DataFrame, row: str, query: str, positives: str, negatives: str, most_positive: int = 1, most_negative: int = 7) -> DataFrame:
    """(row, position, query, document, label): for each positive its document, then negatives, both in hash order."""
    picked = lambda c, n, seed: F.slice(F.array_sort(F.transform(c, lambda t: F.struct(F.md5(F.concat(seed, t)).alias("h"), t.alias("t")))), 1, n)
    pos = df.select(row, query, negatives, F.posexplode(picked(F.col(positives), most_positive, F.lit("p"))).alias("p", "x"))
    docs = F.concat(F.array(F.struct(F.col("x.t").alias("document"), F.lit(1).alias("label"))), F.transform(picked(F.col(negatives), most_negative, F.col("p").cast("string")), lambda z: F.struct(z["t"].alias("document"), F.lit(0).alias("label"))))
    return pos.select(row, query, "p", F.posexplode(docs).alias("i", "d")).withColumn("position", F.col("p") * (most_negative + 1) + F.col("i")).select(row, "position", F.col(query).alias("query"), "d.document", "d.label")


def class_of(logits: Column) -> Column:
    """struct(label, logprob): the first greatest logit and its log softmax."""
    from quarry.functions.arrays import log_sum_exp

    top = F.array_max(logits)
    return F.struct((F.array_position(logits, top) - 1).cast("int").alias("label"), (top - log_sum_exp(logits)).alias("logprob"))
