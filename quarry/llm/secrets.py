"""Secret scans with built-in functions: single-part spans, and multipart credentials linked by interval joins.

Three kinds are secrets on their own (`assign`, `access`, `hex`).  A credential also comes in parts that look
harmless alone: an access identifier, a secret string and an endpoint.  Parts are weak candidates; one is
reported only if, within SCOPE characters, parts of every other role that its own role needs occur too.

The join: parts of one text never need to leave it.  They are sorted by start, and two running scans, one from each
side, tell every part how far the parts of each role before it reach and where the next part of each role begins.
A part of that role lies within the scope exactly if one of these two is within SCOPE of the part's own ends.  So
texts are read once, nothing is shuffled, and no pair of parts is made.

Scans go over blocks of BLOCK values, whose results are then lifted by those of the blocks before; so work grows in
proportion to the matches of a text (but for one small number per block), also in very long texts.

Nulls count as empty texts and have no spans.  Positions are code points, ends exclusive.  Repeated rows get the same
spans, an empty table an empty result.  Columns of docs named __base or __linked are replaced, other ones stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.rules import let

#: The three base patterns. The lengths in the last two drop the same matches as a later filter would,
#: because both patterns take whole runs.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
BASE_KINDS = ("assign", "access", "hex")

#: Weak parts by role: identifiers, secrets and endpoints.
PARTS = {
    "ident": r"\b(?:A[SGR]IA[A-Z0-9]{12,}|AC[0-9a-f]{20,}|(?:client|account|access|user)[_-]?(?:id|key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{4,})",
    "opaque": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]*[0-9])(?=[A-Za-z0-9+/_=-]*[A-Z])(?=[A-Za-z0-9+/_=-]*[a-z])[A-Za-z0-9+/_=-]{20,}",
    "endpoint": r"\b(?:https?|wss?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3|sftp|ftp)://[^\s\"'<>|]{4,}",
}
#: The other roles that a part of a role needs near it; base access ids and values count as identifiers and secrets.
NEEDS = {"ident": ("opaque",), "opaque": ("ident",), "endpoint": ("ident", "opaque")}
#: Roles of kinds; a run of hex digits is no part.
ROLE = {"assign": "opaque", "access": "ident", "ident": "ident", "opaque": "opaque", "endpoint": "endpoint"}
#: Characters between two parts of one credential.
SCOPE = 300
#: Values that a scan takes at once.
BLOCK = 64
_FAR = 1 << 30
#: Order of kinds at one start.
KINDS = (*BASE_KINDS, *PARTS)


def scans(df: DataFrame, wanted: dict[str, tuple[str, int, Callable[[Column, Column], Column]]]) -> DataFrame:
    """Append for each name: (column v of array<int>, first, op) the array of v[0] op ... op v[i] for each i.

    op is associative and leaves values as they are beside `first`.  Null and empty arrays give null.  Every step is a
    projection of its own: nested deeper, the expressions would be resolved and evaluated over and over.
    """
    none = lambda first: F.struct(F.lit(first).alias("at"), F.array().cast("array<int>").alias("out"))

    def fold(values: Column, first: int, op) -> Column:
        step = lambda acc, x: F.struct(op(acc["at"], x).alias("at"), F.array_append(acc["out"], op(acc["at"], x)).alias("out"))
        return F.aggregate(values, none(first), step, lambda acc: acc["out"])

    def blocks(v: str, first: int, op) -> Column:
        last = F.floor((F.size(v) - 1) / BLOCK).cast("int")
        return F.when(F.size(v) > 0, F.transform(F.sequence(F.lit(0), last), lambda b: fold(F.slice(v, b * BLOCK + 1, BLOCK), first, op)))

    def lifted(name: str, first: int, op) -> Column:
        parts = F.col(f"{name}__in")
        before = fold(F.concat(F.array(F.lit(first)), F.transform(parts, lambda s: F.element_at(s, -1))), first, op)
        return F.when(parts.isNotNull(), let(before, lambda c: F.flatten(F.transform(parts, lambda s, i: F.transform(s, lambda x: op(F.get(c, i), x))))))

    df = df.withColumns({f"{n}__in": blocks(*w) for n, w in wanted.items()})
    return df.withColumns({n: lifted(n, first, op) for n, (_, first, op) in wanted.items()}).drop(*[f"{n}__in" for n in wanted])


def _none() -> Column:
    return F.array().cast("array<struct<start:int,rank:int,stop:int>>")


def _matches(text: Column, pattern: str, group: int) -> Column:
    """struct(steps, hits, sizes) of the leftmost non-overlapping matches; null without any.

    steps: lengths of each match and of the gap before it, hits: of the match, sizes: of its group.
    """
    gap, hit = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), group) if group else F.array().cast("array<string>"), F.length)
    steps = lambda g, h: F.struct(F.transform(h, lambda x, i: F.length(F.get(g, i)) + F.length(x)).alias("steps"), F.transform(h, F.length).alias("hits"), sizes.alias("sizes"))
    return F.when(text.rlike(pattern), let(gap, lambda g: let(hit, lambda h: steps(g, h))))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def _of(x: Column, role: str) -> Column:
    return x["rank"].isin(*[i for i, kind in enumerate(KINDS) if ROLE.get(kind) == role])


def find_secrets(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """Append `__base` and `__linked`, arrays of (start, rank of the kind in KINDS, stop), to docs."""
    body = F.coalesce(F.col(text), F.lit(""))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, **PARTS}
    df = docs.drop("__base", "__linked")
    own = df.columns
    df = df.withColumns({f"__m_{k}": _matches(body, p, 2 if k == "assign" else 0) for k, p in patterns.items()})
    df = scans(df, {f"__e_{k}": (f"__m_{k}.steps", 0, lambda a, b: a + b) for k in patterns})

    def spans(k: str) -> Column:
        hits = F.col(f"__m_{k}.hits")
        out = F.transform(f"__e_{k}", lambda e, i: F.struct((e - F.get(hits, i)).alias("start"), F.lit(KINDS.index(k)).alias("rank"), e.alias("stop")))
        if k == "assign":
            out = F.filter(out, lambda x, i: F.get(F.col("__m_assign.sizes"), i) >= ASSIGN_LEAST)
        return F.when(F.col(f"__e_{k}").isNotNull(), out).otherwise(_none())

    df = df.withColumns({f"__s_{k}": spans(k) for k in patterns})
    # Every role needs an identifier or a secret string, and each of these the other.
    some = {r: sum((F.size(f"__s_{k}") for k in ROLE if ROLE[k] == r), F.lit(0)) > 0 for r in ("ident", "opaque")}
    parts = F.when(some["ident"] & some["opaque"], F.array_sort(F.concat(*[f"__s_{k}" for k in ROLE])))
    df = df.withColumns({"__base": F.concat(*[f"__s_{k}" for k in BASE_KINDS]), "__parts": parts})
    values, wanted = {}, {}
    for r in ("ident", "opaque"):
        values[f"__r_{r}"] = F.transform("__parts", lambda x: F.when(_of(x, r), x["stop"]).otherwise(-_FAR))
        values[f"__n_{r}"] = F.reverse(F.transform("__parts", lambda x: F.when(_of(x, r), x["start"]).otherwise(_FAR)))
        # How far parts of the role up to here reach; where the next one from here on begins.
        wanted[f"__reach_{r}"] = (f"__r_{r}", -_FAR, F.greatest)
        wanted[f"__next_{r}"] = (f"__n_{r}", _FAR, F.least)
    df = scans(df.withColumns(values), wanted)
    df = df.withColumns({f"__next_{r}": F.reverse(f"__next_{r}") for r in ("ident", "opaque")})

    def keep(x: Column, i: Column) -> Column:
        near = {r: (x["start"] - F.get(F.col(f"__reach_{r}"), i) <= scope) | (F.get(F.col(f"__next_{r}"), i) - x["stop"] <= scope) for r in ("ident", "opaque")}
        yes = F.lit(False)
        for k, needed in NEEDS.items():
            here = _of(x, k) & (x["rank"] >= len(BASE_KINDS))
            for other in needed:
                here = here & near[other]
            yes = yes | here
        return yes

    linked = F.when(F.col("__parts").isNotNull(), F.filter("__parts", keep)).otherwise(_none())
    return df.select(*own, "__base", linked.alias("__linked"))


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, then n_assign, n_access, n_hex, base_sha256 and spans of every row.

    Columns of docs that have one of these names give way to those appended.
    """
    new = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")
    keep = [c for c in keep if c not in new]
    found = find_secrets(docs.select(*dict.fromkeys([*keep, text])), text)
    count = lambda k: F.size(F.filter("__base", lambda x: x["rank"] == BASE_KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select(*keep, *[count(k) for k in BASE_KINDS], F.sha2(_listed(F.col("__base")), 256).alias("base_sha256"), _listed(F.concat("__base", "__linked")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same rows and columns with every span (overlapping ones merged) replaced by `mark`. Null texts stay null."""
    cols, body = docs.columns, F.col(text)
    df = find_secrets(docs, text).withColumn("__all", F.array_sort(F.concat("__base", "__linked")))
    df = scans(df.withColumn("__stops", F.transform("__all", lambda x: x["stop"])), {"__upto": ("__stops", 0, F.greatest)})
    # A span that begins inside of those before it only lengthens them.
    at = lambda i: F.coalesce(F.get("__upto", i - 1), F.lit(0))
    piece = lambda x, i: F.when(x["start"] >= at(i), F.concat(F.substring(body, at(i) + 1, x["start"] - at(i)), F.lit(mark))).otherwise("")
    tail = F.substring(body, F.element_at("__upto", -1) + 1, F.length(body))
    clean = F.when(body.isNotNull() & (F.size("__all") > 0), F.concat(F.array_join(F.transform("__all", piece), ""), tail)).otherwise(body)
    return df.withColumn(text, clean).select(*cols)


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of secrets in every document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
