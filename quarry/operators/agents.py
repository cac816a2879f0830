"""Agent formats: tools to prompts, tool results to turns and texts to calls."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import parts_of

Call = dict[str, str]
CALLS = "array<struct<name:string,arguments:string>>"


def lenient_json(text: str):
    """The JSON value of a text, also of Python literals; None where it is neither."""
    import ast

    for read in (json.loads, ast.literal_eval):
        try:
            return read(text)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            pass
    return None


def unwrapped(tool: dict) -> dict:
    return tool.get("function", tool)


def wrapped(tool: dict) -> dict:
    return tool if "function" in tool else {"type": "function", "function": tool}


def _call(value) -> list[Call]:
    value = unwrapped(value) if isinstance(value, dict) else None
    if not value or "name" not in value:
        return []
    args = value.get("arguments", value.get("parameters", {}))
    return [{"name": str(value["name"]), "arguments": args if isinstance(args, str) else json.dumps(args, ensure_ascii=False)}]


@dataclass(frozen=True)
class Marks:
    """Words before an action, its input and its result."""

    action: str = "Action:"
    given: str = "Action Input:"
    result: str = "Observation:"


REACT, FLOWERS = Marks(), Marks("✿FUNCTION✿:", "✿ARGS✿:", "✿RESULT✿:")


def react_calls(text: str, marks: Marks = REACT) -> list[Call]:
    """Each action with the input that follows it; marks in any case."""
    words = (marks.given, marks.action, marks.result)
    fixed = {w.lower(): w for w in words}
    parts = parts_of(re.sub("|".join(map(re.escape, words)), lambda m: fixed[m.group().lower()], text, flags=re.IGNORECASE), words)
    out, name = [], None
    for p in parts:
        if p["key"] == marks.action and name is None:
            name = p["content"].strip()
        elif p["key"] == marks.given and name is not None:
            out.append({"name": name, "arguments": p["content"].strip()})
            name = None
    return out


def _json_calls(pattern: str, key: str = "arguments") -> Callable[[str], list[Call]]:
    """Calls as JSON objects with a name and `key`, one in each match; without any, those of the ReAct form."""
    find = re.compile(pattern, re.DOTALL)

    def read(text: str) -> list[Call]:
        values = [lenient_json(x.strip()) for x in find.findall(text)]
        return [c for v in values if isinstance(v, dict) and "name" in v and key in v for c in _call(v)] or react_calls(text)

    return read


tagged_calls = _json_calls(r"<tool_call>(.+?)</tool_call>")


def fenced_calls(text: str) -> list[Call]:
    """A name and a JSON fence within each tag."""
    found = re.findall(r"<tool_call>(.+?)\n```json(.+?)```</tool_call>", text, re.DOTALL)
    return [{"name": n, "arguments": json.dumps(lenient_json(a.strip()), ensure_ascii=False)} for n, a in found] or react_calls(text)


def named_block_calls(text: str) -> list[Call]:
    """Of each turn of the assistant: a name at the end of a line, JSON arguments on the next."""
    out = []
    for turn in text.split("<|assistant|>"):
        m = re.search(r"([^\n`]*?)\n({.*?})(?=\w*\n|$)", turn.replace("<|observation|>", ""), re.DOTALL)
        if m:
            out.append({"name": m[1], "arguments": m[2]})
    return out or react_calls(text)


def bracketed_calls(text: str) -> list[Call]:
    """JSON objects or lists on the lines of the first [TOOL_CALLS][...]</s>; nothing without it."""
    block = re.search(r"\[TOOL_CALLS\]\[(.*?)\]</s>", text, re.DOTALL)
    if not block:
        return []
    values = [v for line in block[1].strip().split("\n") for x in [lenient_json(line)] for v in (x if isinstance(x, list) else [x])]
    return [c for v in values if isinstance(v, dict) and "arguments" in v for c in _call(v)] or react_calls(text)


def xml_calls(text: str) -> list[Call]:
    """Functions and parameters as tags, within each <tool_call>."""
    out = []
    for block in re.findall(r"<tool_call>(.+?)</tool_call>", text, re.DOTALL):
        m = re.fullmatch(r"<function=([^>]+)>(.*)</function>", block.strip(), re.DOTALL)
        if m:
            args = {k.strip(): v.strip() for k, v in re.findall(r"<parameter=([^>]+)>\s*(.*?)\s*</parameter>", m[2], re.DOTALL)}
            out.append({"name": m[1].strip(), "arguments": json.dumps(args, ensure_ascii=False)})
    return out or react_calls(text)


# What each format tells the model, how it describes a tool, and the marks around results.

REACT_TOOL = {
    "en": "{name}: Call this tool to interact with the {shown} API. What is the {shown} API useful for? {description} Parameters: {parameters} Format the arguments as a JSON object.",
    "zh": "{name}: 调用此工具与 {shown} API 进行交互。{shown} 有什么用？{description} 输入参数：{parameters} 此工具的输入应为JSON对象。",
}
REACT_TEXT = {
    "en": """Answer the following questions as best you can. You have access to the following tools:

<<TOOLS>>

Use the following format:

Question: the input question you must answer
Thought: you should always think about what to do
Action: the action to take, should be one of [<<NAMES>>]
Action Input: the input to the action
Observation: the result of the action
... (this Thought/Action/Action Input/Observation can be repeated zero or more times)
Thought: I now know the final answer
Final Answer: the final answer to the original input question

Begin!
""",
    "zh": """尽可能地回答以下问题。你可以使用以下工具:

<<TOOLS>>

请按照以下格式进行:

Question: 需要你回答的输入问题
Thought: 你应该总是思考该做什么
Action: 需要使用的工具，应该是[<<NAMES>>]中的一个
Action Input: 传入工具的内容
Observation: 行动的结果
... (这个Thought/Action/Action Input/Observation可以重复N次)
Thought: 我现在知道最后的答案
Final Answer: 对原始输入问题的最终答案

现在开始！
""",
}
THINKING_REACT_TEXT = """A conversation for tool calling between User and Assistant. The user asks a question which may be solved by calling tools, and the Assistant solves it. The assistant first thinks about the reasoning process in the mind and then provides the user with the answer. The reasoning process should be enclosed within <think> </think>tags and answer should follow the ReACT format(Action:xxx\nAction Input:xxx), i.e., <think> reasoning process here </think> Action: action here\nAction Input: parameters here

Answer the following questions as best as you can. You have access to the following tools:

<<TOOLS>>

Use the following format:

<think>you should always think about what to do</think>
Action: the action to take, should be one of [<<NAMES>>]
Action Input: the input to the action
Observation: the result of the action, given by the actual calling
... (this Thought/Action/Action Input/Observation can be repeated zero or more times)
Final Answer: the final answer to the original input question

Begin!
"""
FLOWER_TOOL = {
    "en": "### {shown}\n\n{name}: {description} Parameters: {parameters} Format the arguments as a JSON object.",
    "zh": "### {shown}\n\n{name}: {description} 输入参数：{parameters} 此工具的输入应为JSON对象。",
}
FLOWER_TEXT = {
    ("en", False): """<<SYSTEM>>

# Tools

## You have access to the following tools:

<<TOOLS>>

## When you need to call a tool, please insert the following command in your reply, which can be called zero or multiple times according to your needs:

✿FUNCTION✿: The tool to use, should be one of [<<NAMES>>]
✿ARGS✿: The input of the tool
✿RESULT✿: Tool results
✿RETURN✿: Reply based on tool results. Images need to be rendered as ![](url)""",
    ("zh", False): """<<SYSTEM>>

# 工具

## 你拥有如下工具：

<<TOOLS>>

## 你可以在回复中插入零次、一次或多次以下命令以调用工具：

✿FUNCTION✿: 工具名称，必须是[<<NAMES>>]之一。
✿ARGS✿: 工具输入
✿RESULT✿: 工具结果
✿RETURN✿: 根据工具结果进行回复，需将图片用![](url)渲染出来""",
    ("en", True): """<<SYSTEM>>

# Tools

## You have access to the following tools:

<<TOOLS>>

## Insert the following command in your reply when you need to call N tools in parallel:

✿FUNCTION✿: The name of tool 1, should be one of [<<NAMES>>]
✿ARGS✿: The input of tool 1
✿FUNCTION✿: The name of tool 2
✿ARGS✿: The input of tool 2
...
✿FUNCTION✿: The name of tool N
✿ARGS✿: The input of tool N
✿RESULT✿: The result of tool 1
✿RESULT✿: The result of tool 2
...
✿RESULT✿: he result of tool N
✿RETURN✿: Reply based on tool results. Images need to be rendered as ![](url)""",
    ("zh", True): """<<SYSTEM>>

# 工具

## 你拥有如下工具：

<<TOOLS>>

## 你可以在回复中插入以下命令以并行调用N个工具：

✿FUNCTION✿: 工具1的名称，必须是[<<NAMES>>]之一
✿ARGS✿: 工具1的输入
✿FUNCTION✿: 工具2的名称
✿ARGS✿: 工具2的输入
...
✿FUNCTION✿: 工具N的名称
✿ARGS✿: 工具N的输入
✿RESULT✿: 工具1的结果
✿RESULT✿: 工具2的结果
...
✿RESULT✿: 工具N的结果
✿RETURN✿: 根据工具结果进行回复，需将图片用![](url)渲染出来""",
}
TAGGED_HEAD = """# Tools

You may call one or more functions to assist with the user query.

You are provided with function signatures within <tools></tools> XML tags:
<tools>
<<TOOLS>>
</tools>

"""
TAGGED_TEXT = TAGGED_HEAD + """For each function call, return a json object with function name and arguments within <tool_call></tool_call> XML tags:
<tool_call>
{"name": <function-name>, "arguments": <args-json-object>}
</tool_call>"""
FENCED_TEXT = TAGGED_HEAD + """For function call returns, you should first print <tool_calls>For each function call, you should return object like:
<tool_call>function_name
```json
function_arguments_in_json_format
```</tool_call>At the end of function call returns, you should print </tool_calls>"""
TREE_SYSTEM = "You are Qwen, a helpful AI assistant that can interact with a computer to solve tasks."
TREE_HEAD = "# Tools\n\nYou have access to the following functions:\n\n<tools>\n"
TREE_TAIL = """
</tools>

If you choose to call a function ONLY reply in the following format with NO suffix:

<tool_call>
<function=example_function_name>
<parameter=example_parameter_1>
value_1
</parameter>
<parameter=example_parameter_2>
This is the value for the second parameter
that can span
multiple lines
</parameter>
</function>
</tool_call>

<IMPORTANT>
Reminder:
- Function calls MUST follow the specified format: an inner <function=...></function> block must be nested within <tool_call></tool_call> XML tags
- Required parameters MUST be specified
- You may provide optional reasoning for your function call in natural language BEFORE the function call, but NOT after
- If there is no function call available, answer the question like normal with your current knowledge and do not tell the user about function calls
</IMPORTANT>"""
SUBTASK_TEXT = """You can use many tools(functions) to do the following task.
First I will give you the task description, and your task start.
At each step, you need to give your thought to analyze the status now and what to do next, with a function call to actually execute your step. Your output should follow this format:
Thought:
Action:
Action Input:

After the call, you will get the call result, and you are now in a new state.
Then you will analyze your status now, then decide what to do next...
After many (Thought-call) pairs, you finally perform the task, then you can give your final answer.
Remember:
1.the state change is irreversible, you can't go back to one of the former state, if you want to restart the task, say "I give up and restart".
2.All the thought is short, at most in 5 sentence.
3.You can do more then one try, so if your plan is to continuously try some conditions, you can do one of the conditions per try.
Let's Begin!
Task description: You should use functions to help handle the real time user queries. Remember:
1.ALWAYS call "Finish" function at the end of the task. And the final answer should contain enough information to show to the user,If you can't handle the task, or you find that function calls always fail(the function is not valid now), use function Finish->give_up_and_restart.
2.Do not use origin tool names, use only subfunctions' names.
Specifically, you have access to the following APIs: <<TOOLS>>"""
BLOCK_SYSTEM = "你是一个名为 GLM-4 的人工智能助手。你是基于智谱AI训练的语言模型 GLM-4 模型开发的，你的任务是针对用户的问题和要求提供适当的答复和支持。\n\n"
BLOCK_HEAD = "# 可用工具\n\n"
BLOCK_TOOL = "## {name}\n\n{body}\n在调用上述函数时，请使用 Json 格式表示调用的参数。"
ASKED_TEXT = """Given the following functions, please respond with a JSON for a function call with its proper arguments that best answers the given prompt.

Respond in the format {"name": function name, "parameters": dictionary of argument name and its value}. Do not use variables.

<<TOOLS>>

<<QUERY>>"""
HEADERS = {"llama3": ("<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>"), "llama4": ("<|header_start|>", "<|header_end|>", "<|eot|>")}
# End of the fixed values.


def _filled(text: str, **values: str) -> str:
    return re.sub("<<([A-Z]+)>>", lambda m: values[m[1].lower()], text)


def _dumped(value, indent: int | None = None) -> str:
    return json.dumps(value, ensure_ascii=False, indent=indent)


def _described(tool: dict, form: str) -> tuple[str, str]:
    t = unwrapped(tool)
    name, p = t.get("name_for_model") or t.get("name"), t.get("parameters") or {}
    about = t["description"] if t.get("description") is not None else t.get("description_for_model")
    if name is None or about is None:
        raise ValueError(f"a tool needs a name and a description: {tool}")
    return name, form.format(name=name, shown=t.get("name_for_human") or name, description=about, parameters=p if isinstance(p, str) else _dumped(p))


def _by_description(text: str, form: str) -> Callable[[list[dict], str | None], str]:
    def tell(tools: list[dict], system: str | None) -> str:
        named = [_described(t, form) for t in tools]
        return _filled(text, system=system or "", tools="\n\n".join(d for _, d in named), names=",".join(n for n, _ in named))

    return tell


def _by_json(text: str, lead: Callable[[str], str]) -> Callable[[list[dict], str | None], str]:
    return lambda tools, system: lead(system or "") + _filled(text, tools="\n".join(_dumped(wrapped(t)) for t in tools))


def _blocks(head: str) -> Callable[[list[dict], str | None], str]:
    one = lambda t: BLOCK_TOOL.format(name=t.get("name_for_model") or t.get("name"), body=_dumped(t, 4))
    return lambda tools, system: head + BLOCK_HEAD + "\n".join(one(unwrapped(t)) for t in tools)


def _tags(value: dict, plain: Sequence[str], inner: Callable[[], list[str]], skip: Sequence[str] = ()) -> list[str]:
    """Lines of a node of the tool tree: its plain fields, then inner lines, then all other fields as JSON."""
    own = [f"<{k}>{str(value[k]).strip()}</{k}>" for k in plain if k in value]
    rest = [f"<{k}>{_dumped(v)}</{k}>" for k, v in value.items() if k not in (*plain, *skip)]
    return own + inner() + rest


def _tree(tool: dict) -> str:
    t = unwrapped(tool)
    given = t.get("parameters") if isinstance(t.get("parameters"), dict) else {}
    fields = given.get("properties") if isinstance(given.get("properties"), dict) else {}
    one = lambda k, f: ["<parameter>", *_tags({"name": k, **{x: v for x, v in f.items() if x != "name"}}, ("name", "type", "description"), list), "</parameter>"]
    inside = lambda: ["<parameters>", *[x for k, f in fields.items() for x in one(k, f)], *_tags(given, (), list, ("type", "properties")), "</parameters>"]
    return "\n".join(["<function>", *_tags(t, ("name", "description"), inside, ("type", "parameters")), "</function>"])


def _as_tree(tools: list[dict], system: str | None) -> str:
    return f"{TREE_SYSTEM if system is None else system}\n\n{TREE_HEAD}" + "\n".join(map(_tree, tools)) + TREE_TAIL


def _in_question(tools: list[dict], query: str) -> str:
    return _filled(ASKED_TEXT, tools="\n\n".join(_dumped(t, 4) for t in tools), query=query)


@dataclass(frozen=True)
class AgentFormat:
    """How tools are told (in the system text, or in the user's), calls written and read, and results given back."""

    name: str
    prompt: Callable[[list[dict], str | None], str]
    calls: Callable[[str], list[Call]]
    write: Callable[[list[Call]], str]
    results: Callable[[list[str]], str]
    question: Callable[[list[dict], str], str] | None = None


def _value(call: Call):
    """The arguments as a value; text that is no literal stays text."""
    found = lenient_json(call["arguments"])
    return call["arguments"] if found is None else found


def _react_write(marks: Marks = REACT) -> Callable[[list[Call]], str]:
    return lambda calls: "".join(f"{marks.action} {c['name']}\n{marks.given} {_value(c)}\n" for c in calls) + marks.result


def _react_results(marks: Marks = REACT) -> Callable[[list[str]], str]:
    """Results after the mark that the calls end with; each ends its line."""
    return lambda results: marks.result.join(r if r.endswith("\n") else r + "\n" for r in results)


def _lines(form: str, key: str = "arguments", around: str = "<<CALLS>>") -> Callable[[list[Call]], str]:
    """Calls as JSON objects, each within `form`, all within `around`."""
    return lambda calls: around.replace("<<CALLS>>", "\n".join(form.replace("<<CALL>>", _dumped({"name": c["name"], key: _value(c)})) for c in calls))


def _xml_write(calls: list[Call]) -> str:
    one = lambda c: f"<tool_call>\n<function={c['name']}>\n" + "".join(f"<parameter={k}>\n{_dumped(v) if isinstance(v, dict | list) else v}\n</parameter>\n" for k, v in (lenient_json(c["arguments"]) or {}).items()) + "</function>\n</tool_call>"
    return "\n".join(map(one, calls))


def _block_write(calls: list[Call]) -> str:
    return "<|assistant|>".join(f"{c['name']}\n{_value(c)}" for c in calls) + "<|observation|>"


def _headed(name: str) -> AgentFormat:
    begin, end, over = HEADERS[name]
    read = _json_calls(r'{[^{]*?"name":.*?"parameters":\s*?{.*?}\s*?}', "parameters")
    give = lambda results: over + "".join(f"{begin}tool{end}\n\n{r}{over}" for r in results) + f"{begin}assistant{end}\n\n"
    return AgentFormat(name, lambda tools, system: system or "", read, _lines("<<CALL>>", "parameters"), give, _in_question)


def _flowers(lang: str, parallel: bool) -> AgentFormat:
    name = f"qwen_{lang}{'_parallel' if parallel else ''}"
    return AgentFormat(name, _by_description(FLOWER_TEXT[lang, parallel], FLOWER_TOOL[lang]), lambda t: react_calls(t, FLOWERS), _react_write(FLOWERS), _react_results(FLOWERS))


def _responses(results: list[str]) -> str:
    return "\n".join(f"<tool_response>\n{r}\n</tool_response>" for r in results)


_TAGGED = "<tool_call>\n<<CALL>>\n</tool_call>"
_apart = lambda system: f"{system}\n\n"

FORMATS: dict[str, AgentFormat] = {
    f.name: f
    for f in (
        *[AgentFormat(f"react_{x}", _by_description(REACT_TEXT[x], REACT_TOOL[x]), react_calls, _react_write(), _react_results()) for x in ("en", "zh")],
        AgentFormat("react_grpo", _by_description(THINKING_REACT_TEXT, REACT_TOOL["en"]), react_calls, _react_write(), _react_results()),
        AgentFormat("toolbench", lambda tools, system: _filled(SUBTASK_TEXT, tools=_dumped([unwrapped(t) for t in tools])), react_calls, _react_write(), _react_results()),
        *[_flowers(x, y) for x in ("en", "zh") for y in (False, True)],
        AgentFormat("hermes", _by_json(TAGGED_TEXT, _apart), tagged_calls, _lines(_TAGGED), _responses),
        AgentFormat("hunyuan_hermes", _by_json(FENCED_TEXT, lambda s: s and f"{s}\n\n"), fenced_calls, _lines(_TAGGED, around="<tool_calls>\n<<CALLS>>\n</tool_calls>"), lambda r: "<tool_responses>" + "\n".join(f"<tool_response>{x}</tool_response>" for x in r) + "</tool_responses>"),
        AgentFormat("qwen3_coder", _as_tree, xml_calls, _xml_write, _responses),
        *[AgentFormat(n, _blocks(head), named_block_calls, _block_write, lambda r: "\n" + "<|observation|>\n".join(r) + "<|assistant|>\n") for n, head in (("chatglm4", BLOCK_SYSTEM), ("glm4", ""))],
        *map(_headed, HEADERS),
        AgentFormat("mistral", lambda tools, system: f"{system or ''}[AVAILABLE_TOOLS]{' '.join(_dumped(wrapped(t)) for t in tools)}[/AVAILABLE_TOOLS]", bracketed_calls, _lines("<<CALL>>", around="[TOOL_CALLS][\n<<CALLS>>\n]</s>"), lambda r: "\n".join(f"[TOOL_RESULTS]{_dumped({'content': x})}[/TOOL_RESULTS]" for x in r)),
    )
}


def register_format(agent: AgentFormat, exist_ok: bool = False) -> None:
    if agent.name in FORMATS and not exist_ok:
        raise ValueError(f"format {agent.name} is already registered")
    FORMATS[agent.name] = agent


def tool_calls(text: Column, agent: str = "hermes") -> Column:
    read = FORMATS[agent].calls

    @F.pandas_udf(CALLS)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: read(t) if t else [])

    return run(text)


def tool_question(tools: Column, query: Column, agent: str = "llama3") -> Column:
    """The user's text with the tools of a JSON list, in formats that tell them there; else the text alone."""
    ask = FORMATS[agent].question

    @F.pandas_udf("string")
    def run(t: pd.Series, q: pd.Series) -> pd.Series:
        return pd.Series([ask(lenient_json(x), y) if ask and x and y is not None else y for x, y in zip(t, q, strict=True)], dtype=object)

    return run(tools, query)


def tool_results(results: Column, agent: str = "hermes") -> Column:
    """Results of an array of texts as the format gives them back."""
    give = FORMATS[agent].results

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: None if r is None else give(list(r)))

    return run(results)


def tool_prompt(tools: Column, system: Column, agent: str = "hermes") -> Column:
    """The system text with the tools of a JSON list; without tools the system text alone."""
    tell = FORMATS[agent].prompt

    @F.pandas_udf("string")
    def run(t: pd.Series, s: pd.Series) -> pd.Series:
        def one(x, y):
            found = lenient_json(x) if x else None
            return tell(found, y) if found else y

        return pd.Series([one(x, y) for x, y in zip(t, s, strict=True)], dtype=object)

    return run(tools, system)


def written_calls(calls: Column, agent: str = "hermes") -> Column:
    write = FORMATS[agent].write

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: write([dict(x) for x in r]))

    return run(calls)
