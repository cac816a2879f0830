"""Specs of sources: `[hub::]id_or_path[:subset/subset][#rows]`."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class SourceSpec:
    source: str
    subsets: tuple[str, ...] = ()
    rows: int | None = None
    hub: str | None = None
    is_path: bool = False


def parse(spec: str, exists: Callable[[str], bool] = os.path.exists) -> SourceSpec:
    """Each mark counts only where what is left is not an existing path; hubs are 'hf' and 'ms' in any case."""
    hub = None
    rest = spec
    if not exists(rest) and "::" in rest:
        head, tail = rest.split("::", 1)
        if head.lower() not in ("hf", "ms"):
            raise ValueError(f"unknown hub {head!r}")
        hub, rest = head.lower(), tail
    rows = None
    if not exists(rest) and "#" in rest:
        rest, n = rest.rsplit("#", 1)
        rows = int(n)
    subsets: tuple[str, ...] = ()
    if not exists(rest) and ":" in rest:
        rest, s = rest.split(":", 1)
        subsets = tuple(x.strip() for x in s.split("/"))
    return SourceSpec(rest, subsets, rows, hub, exists(rest))
