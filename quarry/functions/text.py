"""Text functions on columns; built-in expressions wherever they can say it."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.arrays import let

PARTS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("content", T.StringType())]))


def split_by_pattern(text: str, patterns: Sequence[str]) -> list[str]:
    """Alternate delimiters and contents: the first delimiter is '' where the text does not begin with one."""
    out, at = [], 0
    begin = ""
    for m in re.finditer("|".join(f"(?:{p})" for p in patterns), text, re.DOTALL):
        if m.start() > 0 or out or begin:
            out += [begin, text[at : m.start()]]
        begin, at = m.group(), m.end()
    return [*out, begin, text[at:]]


def parts_of(text: str, delimiters: Sequence[str], regex: bool = False) -> list[dict[str, str]]:
    """Literal: each delimiter with the text up to the next one. Regex: non-empty parts, key the first pattern that matches a part's start."""
    cut = split_by_pattern(text, delimiters if regex else [re.escape(d) for d in delimiters])
    pairs = list(zip(cut[::2], cut[1::2], strict=True))
    if not regex:
        return [{"key": k, "content": c} for k, c in pairs if k or c]
    flat = [x for pair in pairs for x in pair if x]
    return [{"key": next((p for p in delimiters if re.match(p, x, re.DOTALL)), ""), "content": x} for x in flat]


def split_parts(col: Column, delimiters: Sequence[str], regex: bool = False) -> Column:
    """parts_of() for every row; a null text has no parts."""
    fixed = list(delimiters)

    @F.pandas_udf(PARTS)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if t is None else parts_of(t, fixed, regex))

    return run(col)


def fill_placeholders(template: Column, values: dict[str, Column]) -> Column:
    """Replace each {{NAME}} literally, in the order given; null values become empty."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{{" + name + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def bbox_text(bbox: Column) -> Column:
    """(x1,y1),(x2,y2) of a flat array of coordinates."""
    pairs = F.transform(F.sequence(F.lit(0), (F.size(bbox) / 2).cast("int") - 1), lambda i: F.concat(F.lit("("), F.get(bbox, (2 * i).cast("int")).cast("string"), F.lit(","), F.get(bbox, (2 * i + 1).cast("int")).cast("string"), F.lit(")")))
    return F.array_join(pairs, ",")


def strip_thinking(text: Column, prefix: str = "") -> Column:
    """What follows the last </think>, trimmed, after a fixed prefix; texts without the mark stay as they are."""
    return F.when(F.contains(text, F.lit("</think>")), F.concat(F.lit(prefix), F.trim(F.substring_index(text, "</think>", -1), F.lit(" \t\n\r")))).otherwise(text)


def add_thinking_prefix(text: Column, prefix: str, marks: Sequence[str] = ("<think>",)) -> Column:
    has = F.lit(False)
    for m in (*marks, prefix):
        has = has | F.startswith(text, F.lit(m))
    return F.when(has, text).otherwise(F.concat(F.lit(prefix), text))


def add_media_tags(text: Column, n_media: Column, tag: str = "<image>") -> Column:
    """Put missing media tags before the text, so that each medium has one."""
    missing = F.greatest(n_media - F.regexp_count(text, F.lit(re.escape(tag))), F.lit(0)).cast("int")
    return F.concat(F.repeat(F.lit(tag), missing), text)


def final_answer(text: Column) -> Column:
    """The last <answer> body, else what follows the last </think>, else the text; trimmed."""
    body = F.element_at(F.regexp_extract_all(text, F.lit(r"(?s)<answer>(.*?)</answer>"), 1), -1)
    tail = F.substring_index(text, "</think>", -1)
    return F.trim(F.when(F.rlike(text, F.lit(r"(?s)<answer>.*?</answer>")), body).otherwise(tail), F.lit(" \t\n\r"))


#: Number words of the answer normaliser.
NUMBER_WORDS = {"none": "0", "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10"}


def normalize_answer(text: Column) -> Column:
    """Lower case; punctuation becomes blanks except , and . between digits; articles go; number words become digits."""
    x = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\s.,_]", " ")
    x = F.regexp_replace(x, r"(?<!\d)[.,]|[.,](?!\d)", " ")
    w = F.filter(F.split(x, r"\s+"), lambda t: (t != "") & ~t.isin("a", "an", "the"))
    pairs = F.create_map(*[F.lit(v) for kv in NUMBER_WORDS.items() for v in kv])
    return F.array_join(F.transform(w, lambda t: F.coalesce(F.try_element_at(pairs, t), t)), " ")


def vqa_accuracy(pred: Column, refs: Column) -> Column:
    """Normalised equality with a single reference; of several, a third for each that is equal, 1 at most."""
    hits = let(normalize_answer(pred), lambda p: F.size(F.filter(F.transform(refs, normalize_answer), lambda r: r == p)))
    return F.when(F.size(refs) == 1, hits.cast("double")).otherwise(F.least(hits / 3, F.lit(1.0)))


def first_yes_no(text: Column, ascii_words: bool = False) -> Column:
    """'yes' or 'no' in either case, whichever stands first as a word; null without either. Words are of letters, numbers and _; with ascii_words, of those in ASCII."""
    # No \b: which characters it takes for a word's depends on Java's version. Java looks back by UTF-16 units, of which a letter has one or two.
    w, units = ("[A-Za-z0-9_]", "") if ascii_words else (r"[\p{L}\p{N}_]", "{1,2}")
    hit = F.regexp_extract(text, rf"(?i)(?<!{w}{units})(yes|no)(?!{w})", 1)
    return F.nullif(F.lower(hit), F.lit(""))


def choice_letter(text: Column) -> Column:
    """The first A-D that stands alone, of an answer in upper case; null without one."""
    hit = F.regexp_extract(F.upper(text), r"(?<![A-Z0-9])([A-D])(?![A-Z0-9])", 1)
    return F.when(hit != "", hit)


def normalized_name(text: Column) -> Column:
    """Trimmed, lower case, with -, @ and blanks as underscores."""
    return F.translate(F.lower(F.trim(text)), "-@ ", "___")


def conversation_text(messages: Column) -> Column:
    """'Role | content' lines of a conversation."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.initcap(m["role"]), F.lit(" | "), m["content"])), "\n")


def mean_reward(choices: Column) -> Column:
    """Mean of the numbers after 'Reward:' over the choices that hold one; 0 without any."""
    found = F.filter(F.transform(choices, lambda c: F.regexp_extract(c, r"Reward:\s*([0-1](?:\.\d+)?)", 1)), lambda x: x != "")
    total = F.aggregate(found, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.when(F.size(found) > 0, total / F.size(found)).otherwise(F.lit(0.0))


def word_counts_overlap(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two word arrays."""
    count = lambda words, w: F.size(F.filter(words, lambda x: x == w))
    both = lambda x, y: F.aggregate(F.array_intersect(x, y), F.lit(0), lambda acc, w: acc + F.least(count(x, w), count(y, w)))
    return let(a, lambda x: let(b, lambda y: both(x, y)))


def token_f(a: Column, b: Column, beta: float = 1.0) -> Column:
    """F-beta of a prediction's words against a reference's; both empty: 1, one empty: 0."""
    na, nb, b2 = F.size(a), F.size(b), beta * beta

    def of(both: Column) -> Column:
        p, r = both / na, both / nb
        return F.when((na == 0) & (nb == 0), 1.0).when((na == 0) | (nb == 0) | (both == 0), 0.0).otherwise((1 + b2) * p * r / (b2 * p + r))

    return let(word_counts_overlap(a, b).cast("double"), of)


def media_kind(path: Column) -> Column:
    """image, video or audio by the extension, else other."""
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)(?:\?.*)?$", 1))
    return F.when(ext.isin("jpg", "jpeg", "png", "gif", "bmp", "webp", "tiff"), "image").when(ext.isin("mp4", "avi", "mkv", "mov", "webm", "flv", "mpeg"), "video").when(ext.isin("mp3", "wav", "flac", "ogg", "m4a", "aac"), "audio").otherwise("other")


def literal_to_json(text: Column) -> Column:
    """A Python literal as JSON text where its quotes and constants can be told; for from_json."""
    x = F.regexp_replace(text, r"\bTrue\b", "true")
    x = F.regexp_replace(F.regexp_replace(x, r"\bFalse\b", "false"), r"\bNone\b", "null")
    x = F.regexp_replace(x, r"(?<=[\[{,:(\s])'|^'", '"')
    x = F.regexp_replace(x, r"'(?=\s*[\]},:)])|'$", '"')
    return F.regexp_replace(F.regexp_replace(x, r"\}\s*\{", "},{"), r"\(", "[")


def dataset_name(path: Column) -> Column:
    """The last part of an id or path; of a hub's cache folder the name within."""
    bare = F.regexp_replace(path, "/+$", "")
    cached = F.regexp_extract(bare, "/datasets--.+?--(.+?)/snapshots/", 1)
    return F.when(cached != "", cached).otherwise(F.substring_index(bare, "/", -1))
