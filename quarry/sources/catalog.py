"""A catalog of datasets by name, id or path."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Subset:
    name: str = "default"
    subset: str = "default"
    columns: Mapping[str, str] = field(default_factory=dict)
    split: tuple[str, ...] = ("train",)
    weak: bool = False


@dataclass(frozen=True)
class Dataset:
    """What is known of a dataset; `prepare` is a DataFrame transformation, `loader` replaces the reader."""

    name: str | None = None
    ms_id: str | None = None
    hf_id: str | None = None
    path: str | None = None
    subsets: tuple[Subset, ...] = (Subset(),)
    columns: Mapping[str, str] = field(default_factory=dict)
    prepare: Callable[[DataFrame], DataFrame] | None = None
    loader: Callable[[SparkSession, Dataset, Subset], DataFrame] | None = None
    tags: tuple[str, ...] = ()

    @property
    def key(self) -> object:
        return self.name or (self.ms_id, self.hf_id, self.path)


class Catalog:
    def __init__(self) -> None:
        self.entries: dict[object, Dataset] = {}

    def register(self, dataset: Dataset, exist_ok: bool = False) -> None:
        if dataset.key in self.entries and not exist_ok:
            raise ValueError(f"{dataset.key} is already registered")
        self.entries[dataset.key] = dataset

    def register_info(self, info: str | list[dict]) -> list[Dataset]:
        """Register a list of dicts, JSON text or a JSON file, whose relative dataset_path counts from its folder."""
        base = ""
        if isinstance(info, str):
            if os.path.exists(info):
                base = os.path.dirname(os.path.abspath(info))
                with open(info, encoding="utf-8") as f:
                    info = json.load(f)
            else:
                info = json.loads(info)
        out = []
        for d in info:
            path = d.get("dataset_path")
            if path and not os.path.isabs(path):
                path = os.path.join(base, path)
            subsets = tuple(Subset(s, s) if isinstance(s, str) else Subset(s.get("name", s.get("subset", "default")), s.get("subset", "default"), s.get("columns", {}), tuple(s.get("split", ("train",)))) for s in d.get("subsets", ["default"]))
            one = Dataset(d.get("dataset_name"), d.get("ms_dataset_id"), d.get("hf_dataset_id"), path, subsets, d.get("columns", {}), tags=tuple(d.get("tags", ())))
            self.register(one)
            out.append(one)
        return out

    def find(self, source: str, hub: str | None = None) -> Dataset:
        """By name; by exact id of the hub or path; by the last part of an id; else a dataset without further facts."""
        if source in self.entries:
            return self.entries[source]
        ids = lambda d: [x for x in ((d.hf_id,) if hub == "hf" else (d.ms_id,) if hub == "ms" else (d.ms_id, d.hf_id, d.path)) if x]
        for d in self.entries.values():
            if source in ids(d):
                return d
        tail = source.rstrip("/").rsplit("/", 1)[-1]
        for d in self.entries.values():
            if any(x.rstrip("/").rsplit("/", 1)[-1] == tail for x in ids(d)):
                return d
        return Dataset(path=source)

    @staticmethod
    def choose(dataset: Dataset, names: tuple[str, ...]) -> list[Subset]:
        """No name: the only subset, or 'default'; 'all': those that are not weak; unknown names read ad hoc."""
        known = {s.name: s for s in dataset.subsets}
        if not names:
            if len(known) == 1:
                return list(known.values())
            if "default" in known:
                return [known["default"]]
            raise ValueError(f"choose a subset of {sorted(known)}")
        if names == ("all",):
            return [s for s in dataset.subsets if not s.weak]
        return [known.get(n, Subset(n, n)) for n in names]


CATALOG = Catalog()
