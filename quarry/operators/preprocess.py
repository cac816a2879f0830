"""Row preprocessors: column renames, conversation schemas and row checks, as DataFrame transformations."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.arrays import sorted_box

MESSAGE = "struct<role:string,content:string>"
MESSAGES = f"array<{MESSAGE}>"

#: Column names of the common schema, and the names each is also known by.
PAIR_KEYS = ("messages", "images", "videos", "audios", "tools", "objects")
STANDARD_KEYS = tuple(p + k for p in ("", "rejected_", "positive_", "negative_") for k in PAIR_KEYS) + ("rejected_response", "label", "channel", "margin", "teacher_prompt", "chat_template_kwargs", "ref_audios", "audio_codes")
ALIASES = {
    "system": ("system", "system_prompt"),
    "query": ("query", "prompt", "input", "instruction", "question", "problem"),
    "response": ("response", "answer", "output", "targets", "target", "answer_key", "answers", "solution", "text", "completion", "content"),
    "images": ("image", "images"),
    "audios": ("audio", "audios"),
    "videos": ("video", "videos"),
}
ROLES = ("system", "user", "tool_call", "tool_response", "tool", "assistant")
ROLE_NAMES = {
    "user": ("user", "human"),
    "assistant": ("assistant", "gpt", "bot"),
    "tool_call": ("tool_call", "function_call"),
    "tool_response": ("tool_response", "function_response", "observation", "observations"),
}


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename source to target, source names in any case. Where several present sources share a target, all of them stay."""
    present = {c.lower(): c for c in df.columns}
    wanted: dict[str, list[str]] = {}
    for source, target in mapping.items():
        if source.lower() in present:
            wanted.setdefault(target, []).append(present[source.lower()])
    chosen = {sources[0]: target for target, sources in wanted.items() if len(set(sources)) == 1 and sources[0] != target}
    return df.withColumnsRenamed(chosen)


def alias_columns(df: DataFrame, targets: tuple[str, ...] = tuple(ALIASES)) -> DataFrame:
    """Give columns the names of the common schema by the alias table."""
    return rename_columns(df, {a: t for t in targets for a in ALIASES[t]})


def keep_standard(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Project to the columns of the common schema that are present."""
    return df.select(*[c for c in df.columns if c in STANDARD_KEYS or c in extra])


def with_solution(df: DataFrame, change) -> DataFrame:
    """Apply change, keeping the column `solution` as it was before."""
    if "solution" not in df.columns:
        return change(df)
    out = change(df.withColumn("__solution", F.col("solution")))
    return out.withColumn("solution", F.col("__solution")).drop("__solution")


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))


def with_content(messages: Column) -> Column:
    return F.filter(messages, lambda m: m["content"].isNotNull())


def history_messages(history: Column, system: Column | None = None) -> Column:
    """Messages of [query, response] pairs, system first; sides that are null are skipped."""
    pairs = F.transform(F.coalesce(history, F.array().cast("array<array<string>>")), lambda h: F.array(message("user", F.get(h, F.lit(0))), message("assistant", F.get(h, F.lit(1)))))
    flat = F.flatten(pairs).cast(MESSAGES)
    return with_content(flat if system is None else F.concat(F.array(message("system", system)), flat))


def messages_history(messages: Column) -> Column:
    """struct(system, history): pairs of the turns without system; an odd end gets a null response."""
    turns = F.filter(messages, lambda m: m["role"] != "system")
    n = F.ceil(F.size(turns) / 2).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    pairs = F.transform(at, lambda i: F.array(F.get(turns, 2 * i)["content"], F.get(turns, 2 * i + 1)["content"]))
    system = F.get(F.filter(messages, lambda m: m["role"] == "system"), F.lit(0))["content"]
    return F.struct(system.alias("system"), pairs.alias("history"))


def response_messages(df: DataFrame) -> DataFrame:
    """query, response, history and system (those present) become messages; a list of responses gives its first."""
    has = lambda c: c in df.columns
    null = F.lit(None).cast("string")
    response = F.col("response") if has("response") else null
    if has("response") and dict(df.dtypes)["response"].startswith("array"):
        response = F.get("response", F.lit(0))
    last = F.array(F.array(F.col("query").cast("string") if has("query") else null, response.cast("string")))
    history = F.concat(F.coalesce(F.col("history"), F.array().cast("array<array<string>>")), last) if has("history") else last
    out = df.withColumn("messages", history_messages(history, F.col("system") if has("system") else None))
    return out.drop("query", "response", "history", "system")


def instruction_messages(df: DataFrame) -> DataFrame:
    """instruction and input joined by a line break where both are given; output is the response."""
    filled = lambda c: F.when(F.col(c) != "", F.col(c)) if c in df.columns else F.lit(None).cast("string")
    query = F.coalesce(F.concat(filled("instruction"), F.lit("\n"), filled("input")), filled("instruction"), filled("input"), F.lit(""))
    out = df.withColumn("query", query).drop("instruction", "input")
    return response_messages(rename_columns(out, {"output": "response"}))


def class_rows(df: DataFrame) -> DataFrame:
    """Query and response as messages, and the label as a whole number."""
    out = response_messages(alias_columns(df, ("system", "query", "response")))
    return out.withColumn("label", F.col("label").cast("double").cast("long"))


def map_rows(df: DataFrame, change: Callable[[dict], dict | list[dict] | None], schema: str) -> DataFrame:
    """change(row) for each row as a dict: one row, several, or none. Rows go through Python in Arrow batches."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                got = change(row)
                out += got if isinstance(got, list) else [] if got is None else [got]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return df.mapInArrow(run, schema)


def canonical_role(role: Column) -> Column:
    name = F.replace(F.lower(role), F.lit("-"), F.lit("_"))
    for target, names in ROLE_NAMES.items():
        name = F.when(name.isin(*names), target).otherwise(name)
    return name


def canonical_messages(messages: Column, role: str = "role", content: str = "content", system: Column | None = None) -> Column:
    """Messages with canonical roles; null or empty conversations become null; system is put first where none is."""
    out = F.transform(messages, lambda m: F.struct(canonical_role(m[role]).alias("role"), m[content].cast("string").alias("content")))
    if system is not None:
        out = F.when((F.get(out, F.lit(0))["role"] != "system") & system.isNotNull(), F.concat(F.array(message("system", system)), out)).otherwise(out)
    return F.when(F.size(messages) > 0, out)


def pair_messages(turns: Column, first: str, second: str) -> Column:
    """Messages of an array of structs that hold a user's and an assistant's field each."""
    return with_content(F.flatten(F.transform(turns, lambda t: F.array(message("user", t[first]), message("assistant", t[second])))))


def valid_messages(messages: Column) -> Column:
    """At least one message, all roles known, no null content."""
    return F.coalesce((F.size(messages) > 0) & F.forall(messages, lambda m: m["role"].isin(*ROLES) & m["content"].isNotNull()), F.lit(False))


def valid_rejected(messages: Column, rejected: Column) -> Column:
    """rejected is given and differs from the last content."""
    return F.coalesce(rejected != F.element_at(messages, -1)["content"], F.lit(False))


def cleaned(df: DataFrame, strict: bool = False, rejected: str = "rejected_response") -> DataFrame:
    """Drop rows whose conversation fails the checks; strict raises at the first of them instead."""
    ok = valid_messages(F.col("messages"))
    if rejected in df.columns:
        ok = ok & valid_rejected(F.col("messages"), F.col(rejected))
    if strict:
        return df.where(F.when(ok, True).otherwise(F.raise_error(F.lit("a row fails the checks of its messages")).cast("boolean")))
    return df.where(ok)


def slim_messages(messages: Column, fields: tuple[str, ...]) -> Column:
    """Only role, content, loss and loss_scale stay, as far as `fields` holds them."""
    keep = [f for f in ("role", "content", "loss", "loss_scale") if f in fields]
    return F.transform(messages, lambda m: F.struct(*[m[f].alias(f) for f in keep]))


def valid_boxes(boxes: Column) -> Column:
    """All boxes have two or four numbers."""
    return F.forall(boxes, lambda b: F.size(b).isin(2, 4))


def ordered_boxes(boxes: Column) -> Column:
    return F.transform(boxes, lambda b: F.when(F.size(b) == 4, sorted_box(b)).otherwise(b))


def media_list(path: Column) -> Column:
    """A scalar path as a list of {bytes, path}."""
    return F.when(path.isNotNull(), F.array(F.struct(F.lit(None).cast("binary").alias("bytes"), path.alias("path"))))


def rotate_in_batches(df: DataFrame, order: str, value: str, batch: int, name: str = "rejected_response") -> DataFrame:
    """Within runs of `batch` rows by `order`, each row gets the value of the row before; the first gets the last one's."""
    from pyspark.sql import Window

    numbered = ordinal(df, order)
    w = Window.partitionBy("__run").orderBy("ordinal")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = numbered.withColumn("__run", F.floor(F.col("ordinal") / batch))
    return out.withColumn(name, F.coalesce(F.lag(value).over(w), F.last(value).over(whole))).drop("__run")


#: Ranges of ordinal() at most, and rows of the sample of orders for each.
MOST_RANGES = 1024
RANGE_SAMPLE = 32


def range_bounds(df: DataFrame, cols: list[Column], ranges: int) -> list[Column]:
    """Up to ranges - 1 values, as literals, that cut the given total order in about equal parts.

    They come from a random sample of RANGE_SAMPLE * ranges rows; ordinals are the same whatever the bounds.
    """
    names = [f"k{i}" for i in range(len(cols))]
    keys = df.select(*[c.alias(n) for c, n in zip(cols, names, strict=True)])
    picked = keys.withColumn("h", F.rand(7)).orderBy("h").limit(RANGE_SAMPLE * ranges)
    kinds = [f.dataType for f in keys.schema.fields]
    rows = picked.orderBy(*names).drop("h").collect()
    step = max(1, -(-len(rows) // ranges))
    return [F.struct(*[F.lit(v).cast(t).alias(n) for v, t, n in zip(r, kinds, names, strict=True)]) for r in rows[step::step]]


def ordinal(df: DataFrame, *order: str | Column, name: str = "ordinal", ranges: int | None = None) -> DataFrame:
    """0-based numbers in the given ascending order, without putting all rows in one task.

    The bounds of the ranges are found once, from the order's columns alone, and a row's range is an expression of its
    own values; so the pass that counts the ranges and the pass that numbers their rows agree, also after retries.  Only
    the counts, one for each range, meet.  Rows that tie are put in order by a hash of the whole row (columns of maps
    aside); rows that tie there too are equal.  The order should be nearly unique: rows of one value share a task.
    """
    from pyspark.sql import Window

    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranges = min(ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)
    bounds = range_bounds(df, cols, ranges) if ranges > 1 else []
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])
    at = F.size(F.filter(F.array(*bounds), lambda b: b <= key)) if bounds else F.lit(0)
    sizes = {r["p"]: r["count"] for r in df.groupBy(at.alias("p")).count().collect()}
    before, total = [], 0
    for i in range(len(bounds) + 1):
        before.append(total)
        total += sizes.get(i, 0)
    tie = [F.xxhash64(*[c for c, t in df.dtypes if "map<" not in t])] if any("map<" not in t for _, t in df.dtypes) else []
    placed = df.withColumn("__p", at)
    here = F.row_number().over(Window.partitionBy("__p").orderBy(*cols, *tie))
    return placed.withColumn(name, F.get(F.array(*[F.lit(n).cast("long") for n in before]), F.col("__p")) + here - 1).drop("__p")


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: numbers of desirable and undesirable rows and the bounds within which their weights balance."""
    d, u = F.sum(F.when(F.col(label), 1).otherwise(0)), F.sum(F.when(F.col(label), 0).otherwise(1))
    n = df.agg(d.alias("desirable"), u.alias("undesirable"))
    ratio = F.round(F.col("undesirable") / F.col("desirable"), 2)
    back = F.round(F.col("desirable") / F.col("undesirable"), 2)
    return n.withColumns({"desirable_low": ratio, "desirable_high": F.round(ratio * 1.33, 2), "undesirable_low": F.round(back / 1.33, 2), "undesirable_high": back})


def class_prompt(sentence: Column, task: str, categories: tuple[str, ...]) -> Column:
    return F.concat(F.lit(f"Task: {task}\nSentence: "), sentence, F.lit(f"\nCategory: {', '.join(categories)}\nOutput:"))


def class_answer(label: Column, categories: tuple[str, ...]) -> Column:
    """The category of a 0-based label; null for null labels."""
    return F.get(F.array(*[F.lit(c) for c in categories]), label.cast("int"))


def self_cognition(df: DataFrame, name: tuple[str, str], author: tuple[str, str]) -> DataFrame:
    """Fill {{NAME}} and {{AUTHOR}} of query and response, the first form where tag is 'zh', else the second."""
    zh = F.col("tag") == "zh"
    fill = lambda c: F.replace(F.replace(c, F.lit("{{NAME}}"), F.when(zh, name[0]).otherwise(name[1])), F.lit("{{AUTHOR}}"), F.when(zh, author[0]).otherwise(author[1]))
    return df.withColumns({"query": fill(F.col("query")), "response": fill(F.col("response"))})


def with_rejected(messages: Column, rejected: Column) -> Column:
    """The conversation up to the last user turn, followed by the rejected response."""
    n = F.size(messages)
    back = F.array_position(F.transform(F.reverse(messages), lambda m: m["role"]), "user").cast("int")
    return F.concat(F.slice(messages, 1, F.when(back > 0, n - back + 1).otherwise(0)), F.array(message("assistant", rejected)))


def last_user(messages: Column) -> Column:
    """0-based place of the last user turn; -1 without one."""
    back = F.array_position(F.transform(F.reverse(messages), lambda m: m["role"]), "user").cast("int")
    return F.when(back > 0, F.size(messages) - back).otherwise(F.lit(-1))


def replace_last_user(messages: Column, content: Column) -> Column:
    at = last_user(messages)
    return F.transform(messages, lambda m, i: F.when(i == at, message("user", content)).otherwise(m))


def without_response(messages: Column) -> Column:
    """struct(messages, response): the last turn is taken off where the assistant has it."""
    yes = F.element_at(messages, -1)["role"] == "assistant"
    return F.struct(F.when(yes, F.slice(messages, 1, F.size(messages) - 1)).otherwise(messages).alias("messages"), F.when(yes, F.element_at(messages, -1)["content"]).alias("response"))


def flatten_typed_content(parts: Column) -> Column:
    """struct(text, images): typed parts as one text with <image> marks, and the urls in order."""
    text = F.array_join(F.transform(parts, lambda p: F.when(p["type"] == "text", p["text"]).otherwise(F.concat(F.lit("<"), F.replace(p["type"], F.lit("_url"), F.lit("")), F.lit(">")))), "")
    return F.struct(text.alias("text"), F.transform(F.filter(parts, lambda p: p["type"].startswith("image")), lambda p: p["url"]).alias("images"))


def tagged(df: DataFrame, dataset: str) -> DataFrame:
    return df.withColumn("dataset", F.lit(dataset))


def loggable(df: DataFrame) -> DataFrame:
    """Rows as they may be logged: bytes are marked, and texts in columns named after tokens are nulled."""
    out = {c: F.when(F.col(c).isNotNull(), F.lit("<<<bytes>>>")) for c, t in df.dtypes if t == "binary"}
    out |= {c: F.lit(None).cast("string") for c, t in df.dtypes if "_token" in c and t == "string"}
    return df.withColumns(out) if out else df


def auto_preprocess(df: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Pick the preprocessor by the columns: conversations, instructions, or query and response."""
    df = rename_columns(df, columns or {})
    names = set(df.columns)

    def change(df: DataFrame) -> DataFrame:
        for c in ("messages", "conversations", "conversation"):
            if c in names:
                fields = {f.name for f in df.schema[c].dataType.elementType.fields}
                role, content = ("role" if "role" in fields else "from"), ("content" if "content" in fields else "value")
                system = F.col("system") if "system" in names else None
                if role in fields:
                    got = canonical_messages(F.col(c), role, content, system)
                else:
                    pair = [("human" if "human" in fields else "user"), ("assistant" if "assistant" in fields else "gpt")]
                    got = pair_messages(F.col(c), *pair)
                    got = F.concat(F.array(message("system", system)), got) if system is not None else got
                    got = with_content(got)
                return df.withColumn("messages", got).drop(*({"conversation", "conversations", "system"} & names))
        if {"instruction", "input"} <= names:
            return instruction_messages(df)
        return response_messages(alias_columns(df))

    return with_solution(df, change)
