"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

A rule names a measure of the text and the range that a kept text lies in.  quality_rules() computes all
measures, compares them with the table and appends the verdict; no Python runs on the executors and nothing is
shuffled.  Nulls count as empty texts; an empty text fails the base rule (fewer than 20 words).  Repeated rows
are judged one by one, extra columns pass through, an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters between words, symbols, width of the windows that count repeated words.
BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8
#: Frequent function words of four languages.
STOP_WORDS = (
    "the be to of and that have with in is it for on are as was at by an this from or not but "
    "der die das und ist in den von zu mit sich des auf für als auch dem ein eine nicht es im "
    "le la les de et un une des est en que qui dans pour pas sur au avec ce il se par "
    "el los las y que del se por con para una su al lo como es en no más o"
).split()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once, also where use() puts it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK + "+"), "")


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of `width` words that the text holds twice or more, the first one included.

    Windows are compared by 64-bit hashes of the hashes of their words.  Texts whose windows all differ stop
    after one pass; else windows are sorted by hash and the union of the repeated ones is measured.
    """

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - F.lit(width - 1)), lambda i: F.xxhash64(F.slice(h, i, width)))

    def union(s: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(s))
        same = lambda i, j: (j >= 1) & (j <= F.size(s)) & (F.get(s, i - 1)["h"] == F.get(s, j - 1)["h"])
        repeated = F.filter(at, lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
        return let(F.sort_array(F.transform(repeated, lambda i: F.get(s, i - 1)["i"])), covered)

    def covered(p: Column) -> Column:
        gaps = F.aggregate(F.sequence(F.lit(0), F.size(p) - 2), F.lit(0), lambda acc, i: acc + F.least(F.lit(width), F.get(p, i + 1) - F.get(p, i)))
        return F.when(F.size(p) < 2, F.lit(0)).otherwise(gaps + width)

    def measure(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(let(F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), union))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < width, F.lit(0)).otherwise(let(let(hashes, windows), measure)).cast("long")


@dataclass(frozen=True)
class Rule:
    """A text is kept where low <= measure <= high; a null measure passes."""

    name: str
    measure: Callable[[], Column]
    low: float | None = None
    high: float | None = None


def _share(a: str, b: str) -> Callable[[], Column]:
    return lambda: F.col(a) / F.when(F.col(b) > 0, F.col(b))


#: The thresholds; measures may use the columns that measures() appends.
RULES = (
    Rule("mean_word_chars", _share("word_chars", "n_words"), 1.5, 20.0),
    Rule("symbols_per_word", _share("n_symbols", "n_words"), None, 0.25),
    Rule("shouts_per_word", _share("n_shouts", "n_words"), None, 0.5),
    Rule("alphabetic_share", _share("n_letters", "word_chars"), 0.6, None),
    Rule("distinct_stop_words", lambda: F.col("n_stop_words"), 1, None),
    Rule("repeated_line_share", _share("n_dup_lines", "n_lines"), None, 0.3),
    Rule("mean_line_words", _share("n_words", "n_lines"), 1.0, None),
)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_shouts, n_letters, n_stop_words."""
    body = F.coalesce(F.col(text), F.lit(""))
    long = lambda c: c.cast("long")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts", "n_letters", "n_stop_words")
    out = docs.drop(*names).withColumn("__words", word_array(body))
    out = out.withColumn("__lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return out.withColumns(
        {
            "n_words": long(F.size("__words")),
            "word_chars": long(F.length(F.regexp_replace(body, BLANK + "+", ""))),
            "n_symbols": long(F.length(F.regexp_replace(body, SYMBOLS, ""))),
            "n_dup_lines": long(F.size("__lines") - F.size(F.array_distinct("__lines"))),
            "n_repeat_words": repeated_words(F.col("__words")),
            "n_lines": long(F.size("__lines")),
            "n_shouts": long(F.length(F.regexp_replace(body, "[^!]+", ""))),
            "n_letters": long(F.length(F.regexp_replace(body, r"\P{L}+", ""))),
            "n_stop_words": long(F.size(F.array_intersect("__words", F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)])))),
        }
    ).drop("__words", "__lines")


def quality_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, min_words: int = 20, max_repeated_percent: int = 30) -> DataFrame:
    """Append the measures, base_failed, failed_rules array<string> (in table order) and kept.

    base_failed: fewer than min_words words, or more than max_repeated_percent of them inside repeated windows.
    kept: neither base_failed nor any failed rule.  Input columns of these names are replaced.
    """
    out = measures(docs.drop("base_failed", "failed_rules", "kept"), text)
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeated_percent)
    failed = []
    for r in rules:
        m = r.measure()
        bad = (m < r.low if r.low is not None else F.lit(False)) | (m > r.high if r.high is not None else F.lit(False))
        failed.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(r.name)))
    return out.withColumns({"base_failed": base, "failed_rules": F.array_compact(F.array(*failed))}).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    """The verdict on every document."""
    docs = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return docs.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


#: The same over DuckDB; a window counts as repeated where the words themselves are equal.
OP4_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body, row_number() OVER () AS r FROM documents),
w AS (SELECT r, doc_id, body, list_filter(regexp_split_to_array(body, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
p AS (SELECT r, i, list_slice(ws, i, i + 7) AS win FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w WHERE len(ws) >= 8)),
q AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM p) WHERE n > 1),
u AS (SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM q) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(body, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(u.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
  length(regexp_replace(body, '[^!]+', '', 'g')) AS n_shouts, length(regexp_replace(body, '\\P{L}+', '', 'g')) AS n_letters,
  len(list_intersect(ws, [%STOPS%])) AS n_stop_words
  FROM w LEFT JOIN u USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, concat_ws(',',
  CASE WHEN word_chars / nullif(n_words, 0) < 1.5 OR word_chars / nullif(n_words, 0) > 20 THEN 'mean_word_chars' END,
  CASE WHEN n_symbols / nullif(n_words, 0) > 0.25 THEN 'symbols_per_word' END,
  CASE WHEN n_shouts / nullif(n_words, 0) > 0.5 THEN 'shouts_per_word' END,
  CASE WHEN n_letters / nullif(word_chars, 0) < 0.6 THEN 'alphabetic_share' END,
  CASE WHEN n_stop_words < 1 THEN 'distinct_stop_words' END,
  CASE WHEN n_dup_lines / nullif(n_lines, 0) > 0.3 THEN 'repeated_line_share' END,
  CASE WHEN n_words / nullif(n_lines, 0) < 1 THEN 'mean_line_words' END) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM b
""".replace("%STOPS%", ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS)))
