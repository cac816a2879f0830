"""Rule rewards on completion columns, and a registry of them by name."""

from __future__ import annotations

import ast
import asyncio
import math
import operator
import re
from collections.abc import Awaitable, Callable
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.arrays import let, ngrams
from quarry.functions.text import final_answer


def format_reward(text: Column) -> Column:
    """1 for <think>..</think> followed by <answer>..</answer> and nothing else."""
    return F.rlike(text, F.lit(r"(?s)\A<think>.*?</think>\s*<answer>.*?</answer>\z")).cast("double")


def react_format_reward(text: Column) -> Column:
    """1 for <think>..</think>, then Action: and Action Input:."""
    return F.rlike(text, F.lit(r"(?s)\A<think>.*?</think>\s*Action:.*?Action Input:")).cast("double")


def cosine_reward(correct: Column, length: Column, max_length: int, right: tuple[float, float] = (1.0, 0.5), wrong: tuple[float, float] = (-1.0, -0.5)) -> Column:
    """A half cosine over the length: from right[0] down to right[1] where correct, from wrong[0] up to wrong[1] where not."""
    t = F.least(length, F.lit(max_length)) / F.lit(float(max_length))
    curve = lambda a, b: b + 0.5 * (a - b) * (1 + F.cos(t * math.pi))
    return F.when(correct, curve(*right)).otherwise(curve(*wrong))


def repetition_reward(text: Column, n: int = 3, penalty: float = -1.0) -> Column:
    """(1 - distinct / all n-grams) * penalty; 0 for fewer than n words."""
    grams = ngrams(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""), n)
    return let(grams, lambda g: F.when(F.size(g) > 0, (1 - F.size(F.array_distinct(g)) / F.size(g)) * penalty).otherwise(F.lit(0.0)))


def soft_overlong_reward(length: Column, max_length: int, cache: int) -> Column:
    return F.least(-(length - (max_length - cache)) / F.lit(float(cache)), F.lit(0.0))


def action_of(text: Column) -> Column:
    """struct(action, input) of the last Action: and the last Action Input: of a text; 'none' and '{}' where one is missing."""
    blank = F.lit(" \n\t\r")
    name = F.substring_index(F.substring_index(text, "Action:", -1), "Action Input:", 1)
    given = F.substring_index(text, "Action Input:", -1)
    return F.struct(
        F.when(F.contains(text, F.lit("Action:")), F.trim(name, blank)).otherwise("none").alias("action"),
        F.when(F.contains(text, F.lit("Action Input:")), F.trim(given, blank)).otherwise("{}").alias("input"),
    )


def _members(text: Column) -> Column:
    """Members of a JSON object as map<string,string> of JSON texts, so that 2 and "2" differ; null for anything else."""
    fields = F.from_json(text, "map<string,variant>")
    whole = F.try_parse_json(text)
    return F.when(whole.isNotNull() & F.startswith(text, F.lit("{")), F.transform_values(fields, lambda k, v: F.to_json(v)))


def tool_reward(pred: Column, gold: Column) -> Column:
    """1 where the actions are equal and the inputs are JSON objects of the same members; inputs that are no objects give 0."""
    cut = F.when(F.endswith(pred, F.lit("Observation:")), F.substring_index(pred, "Observation:", 1)).otherwise(pred)
    p, g = action_of(F.trim(F.regexp_replace(cut, r"<\|endoftext\|>|<\|im_end\|>", ""))), action_of(gold)
    entries = lambda m: F.array_sort(F.map_entries(m))
    same = entries(_members(p["input"])) == entries(_members(g["input"]))
    return F.when(F.coalesce((p["action"] == g["action"]) & same, F.lit(False)), 1.0).otherwise(0.0)


_OPS = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv}


def evaluate(expression: str) -> Fraction | None:
    """The exact value of + - * / and brackets over numbers; None where it is anything else."""

    def value(node: ast.AST) -> Fraction:
        if isinstance(node, ast.Expression):
            return value(node.body)
        if isinstance(node, ast.BinOp) and type(node.op) in _OPS:
            return _OPS[type(node.op)](value(node.left), value(node.right))
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            return -value(node.operand)
        if isinstance(node, ast.Constant) and isinstance(node.value, int | float) and not isinstance(node.value, bool):
            return Fraction(str(node.value))
        raise ValueError

    try:
        return value(ast.parse(expression.strip(), mode="eval"))
    except (ValueError, SyntaxError, ZeroDivisionError, RecursionError):
        return None


def boxed(text: str) -> str | None:
    """The content of the last \\boxed{}, braces balanced."""
    at = text.rfind("\\boxed{")
    if at < 0:
        return None
    depth, begin = 1, at + 7
    for i in range(begin, len(text)):
        depth += {"{": 1, "}": -1}.get(text[i], 0)
        if not depth:
            return text[begin:i]
    return None


def clean_math(text: str) -> str:
    x = re.sub(r"\\(?:left|right|text|mathrm|,|!|;|quad)|[$\s]", "", text)
    x = re.sub(r"\\[dt]?frac\{([^{}]*)\}\{([^{}]*)\}", r"(\1)/(\2)", x)
    x = re.sub(r"\\(?:times|cdot)", "*", x).replace("^{\\circ}", "").replace("\\%", "").replace("%", "")
    return x.rstrip(".").strip("{}")


def math_equal(pred: str | None, gold: str | None) -> float:
    """1 where the final answers are equal as numbers, or as cleaned text."""
    if not pred or not gold:
        return 0.0
    pick = lambda t: clean_math(boxed(t) if boxed(t) is not None else _tail(t))
    a, b = pick(pred), pick(gold)
    if not b:
        return 0.0
    x, y = evaluate(a.replace(",", "")), evaluate(b.replace(",", ""))
    return float(x == y) if x is not None and y is not None else float(a == b)


def _tail(text: str) -> str:
    body = re.findall(r"<answer>(.*?)</answer>", text, re.DOTALL)
    return body[-1] if body else text.split("</think>")[-1]


def math_reward(pred: Column, gold: Column) -> Column:
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([math_equal(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run(pred, gold)


def accuracy_reward(pred: Column, gold: Column) -> Column:
    """1 where the final answers agree after trimming and lower case, or as numbers."""
    a, b = F.lower(final_answer(pred)), F.lower(final_answer(gold))
    number = lambda x: F.expr("1") * F.when(F.rlike(x, F.lit(r"^-?\d+(\.\d+)?$")), x.cast("double"))
    return F.when((a == b) & (b != ""), 1.0).when(number(a) == number(b), 1.0).otherwise(0.0)


def countdown_reward(text: Column, numbers: Column, target: Column) -> Column:
    """1 where the answer uses each number once and evaluates to the target."""

    @F.pandas_udf("double")
    def run(t: pd.Series, n: pd.Series, g: pd.Series) -> pd.Series:
        out = []
        for text, nums, goal in zip(t, n, g, strict=True):
            body = _tail(text or "").split("=")[0]
            used = sorted(int(x) for x in re.findall(r"\d+", body))
            ok = re.fullmatch(r"[\d+\-*/().\s]+", body) and used == sorted(int(x) for x in nums)
            v = evaluate(body) if ok else None
            out.append(float(v is not None and abs(v - Fraction(str(goal))) < Fraction(1, 100000)))
        return pd.Series(out, dtype="float64")

    return run(text, numbers, target)


def process_reward(text: Column) -> Column:
    """The number after the first 'Reward:', asterisks dropped; 0 where there is none."""
    tail = F.replace(F.trim(F.regexp_extract(text, r"(?s)Reward:(.*)", 1), F.lit(" \n")), F.lit("*"), F.lit(""))
    return F.coalesce(F.try_to_number(F.when(F.rlike(F.trim(tail), F.lit(r"^\d+(\.\d+)?$")), F.trim(tail)), F.lit("999999.999999")).cast("double"), F.lit(0.0))


def thinking_tips(text: Column, tips: Column) -> Column:
    """1 where the thinking part names one of the tips."""
    think = F.lower(F.regexp_extract(text, r"(?s)<think>(.*?)</think>", 1))
    return F.exists(tips, lambda t: F.contains(think, F.lower(t))).cast("double")


def code_format_reward(text: Column, language: str = "python") -> Column:
    return F.rlike(text, F.lit(rf"(?s)\A<think>.*?</think>\s*<answer>.*?```{language}.*?```.*?</answer>\z")).cast("double")


def greedy_call_matches(pred: Column, gold: Column) -> Column:
    """Share of gold calls (texts) that have a partner of their own among the predicted calls."""
    count = lambda x, v: F.size(F.filter(x, lambda y: y == v))
    hit = F.aggregate(F.array_distinct(gold), F.lit(0), lambda acc, g: acc + F.least(count(pred, g), count(gold, g)))
    return F.when(F.size(gold) > 0, hit / F.size(gold)).otherwise(F.when(F.size(pred) == 0, 1.0).otherwise(0.0))


Reward = Callable[..., Column]
REWARDS: dict[str, Reward] = {
    "format": format_reward, "react_format": react_format_reward, "accuracy": accuracy_reward, "cosine": cosine_reward, "repetition": repetition_reward,
    "soft_overlong": soft_overlong_reward, "toolbench": tool_reward, "math": math_reward, "process": process_reward, "countdown": countdown_reward,
    "thinking_tips": thinking_tips, "code_format": code_format_reward, "calls": greedy_call_matches,
}


def register_reward(name: str, reward: Reward, exist_ok: bool = False) -> None:
    if name in REWARDS and not exist_ok:
        raise ValueError(f"reward {name} is already registered")
    REWARDS[name] = reward


def async_reward(df: DataFrame, score: Callable[[str], Awaitable[float]], text: str, name: str = "reward", at_once: int = 64) -> DataFrame:
    """Await score(text) for all rows, `at_once` at a time within a batch."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])

    def run(parts):
        async def all_of(texts):
            gate = asyncio.Semaphore(at_once)

            async def one(t):
                async with gate:
                    return await score(t)

            return await asyncio.gather(*[one(t) for t in texts])

        for p in parts:
            yield p.assign(**{name: [float(x) for x in asyncio.run(all_of(p[text]))]})

    return df.mapInPandas(run, schema)


def reward_matrix(df: DataFrame, rewards: dict[str, Column], weights: dict[str, float], gym: str | None = None) -> DataFrame:
    """Append every reward as a column, `reward` (weighted sum of those there) and `no_reward` where all are null."""
    out = df.withColumns(rewards)
    names = [*rewards, *([gym] if gym else [])]
    total = F.lit(0.0)
    for n in names:
        total = total + F.coalesce(F.col(n), F.lit(0.0)) * weights.get(n, 1.0)
    return out.withColumns({"reward": total, "no_reward": F.forall(F.array(*[F.col(n).isNull() for n in names]), lambda x: x)})
