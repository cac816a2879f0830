"""Readers and writers, and load_dataset(), which goes from specs to training and validation rows."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import preprocess as P
from quarry.operators import sampling as L
from quarry.sources.catalog import CATALOG, Catalog, Dataset, Subset
from quarry.sources.syntax import parse

def read_file(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Read a file or folder by its extension; CSV keeps empty fields as '' and all values as text; JSON may be an array."""
    kind = kind or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "jsonl":
        return spark.read.json(path)
    if kind == "json":
        return spark.read.option("multiLine", True).json(path)
    if kind == "csv":
        return spark.read.csv(path, header=True, multiLine=True, escape='"').na.fill("")
    if kind in ("txt", "text"):
        return spark.read.text(path)
    if kind in ("parquet", "orc"):
        return spark.read.format(kind).load(path)
    raise ValueError(f"no reader for {kind!r}")


def retried(read, times: int = 3, wait: float = 1.0):
    """read(), again after a failure; the last failure is raised."""
    for i in range(times):
        try:
            return read()
        except Exception:
            if i == times - 1:
                raise
            time.sleep(wait * 2**i)
    raise AssertionError


def split_paths(spark: SparkSession, path: str, subset: str, split: str) -> list[str]:
    """Files or folders of one split of one subset under a folder: <subset>/<split>*, or <split>* for the default subset.

    A path that is a file, or a folder without such parts, stands for all.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs

    def found(glob: str) -> list[str]:
        p = hadoop.Path(glob)
        return sorted(str(x.getPath()) for x in p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or [])

    base = path.rstrip("/")
    parts = found(f"{base}/{subset}/{split}*")
    if not parts and subset == "default":
        parts = found(f"{base}/{split}*")
    return parts or [path]


def read_subsets(spark: SparkSession, dataset: Dataset, subsets: Sequence[Subset], retries: int = 1) -> DataFrame:
    """All splits of all subsets, one after the other, by name of columns."""
    frames = []
    for s in subsets:
        if dataset.loader:
            frames.append(dataset.loader(spark, dataset, s))
            continue
        for split in s.split:
            for path in split_paths(spark, dataset.path, s.subset, split):
                df = retried(lambda path=path: read_file(spark, path), retries)
                frames.append(P.rename_columns(df, {**dataset.columns, **s.columns}))
    return L.concat(frames)


def load_dataset(
    spark: SparkSession, specs: str | Sequence[str], split_ratio: float = 0.0, seed: int = 42, shuffle: bool = False, interleave: Sequence[float] | None = None,
    stop: str = "first_exhausted", strict: bool = False, columns: dict[str, str] | None = None, keep_all: bool = False, key: str | None = None, catalog: Catalog = CATALOG,
) -> tuple[DataFrame, DataFrame]:
    """(train, val) of one or more sources: read, rename, preprocess, check, sample, split, tag, combine, shuffle.

    Rows are checked before they are sampled; sampling and splitting go by source, in hash order of `key` (an own
    digest of the row if None), so results do not depend on how files are read.
    """
    trains, vals = [], []
    for text in [specs] if isinstance(specs, str) else specs:
        spec = parse(text)
        dataset = catalog.find(spec.source, spec.hub)
        df = read_subsets(spark, dataset, catalog.choose(dataset, spec.subsets), 3 if spec.hub else 1)
        df = (dataset.prepare or (lambda d: P.auto_preprocess(d, columns)))(df)
        if "messages" in df.columns:
            df = P.cleaned(df, strict)
        if not keep_all:
            df = P.keep_standard(df, extra=("solution", *([key] if key else [])))
        own = key or "__key"
        if not key:
            df = df.withColumn(own, F.md5(F.to_json(F.struct(*df.columns))))
        if spec.rows is not None or split_ratio:
            train, val = L.split(df, split_ratio, own, seed, spec.rows)
        else:
            train, val = df, df.where("false")
        tag = dataset.name or spec.source
        trains.append(P.tagged(train, tag))
        vals.append(P.tagged(val, tag))
    combine = (lambda x: L.interleave(x, list(interleave), key or "__key", seed, stop).drop("slot", "source")) if interleave else L.concat
    train, val = combine(trains), L.concat(vals)
    if shuffle:
        train = L.shuffled(train, key or "__key", seed).orderBy("ordinal").drop("ordinal")
    return tuple(d.drop(*[c for c in ("copy", "__key") if c in d.columns]) for d in (train, val))


def write_cached(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Encoded rows with their lengths as Parquet."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def read_cached(spark: SparkSession, path: str, max_length: int | None = None, rows: int | None = None, key: str | None = None, seed: int = 42) -> DataFrame:
    """Rows whose longest length fits; optionally a sample of them."""
    df = spark.read.parquet(path)
    if max_length is not None:
        kind = dict(df.dtypes)["lengths"]
        df = df.where((F.array_max("lengths") if kind.startswith("array") else F.col("lengths")) <= max_length)
    return df if rows is None else L.sample(df, rows, key, seed).drop("copy")


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines; null fields are written. Appending adds files to the folder."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def save_validation(val: DataFrame, folder: str) -> str:
    """Add split-off validation rows to val_dataset.jsonl of a run's folder; returns its path."""
    path = f"{folder.rstrip('/')}/val_dataset.jsonl"
    write_jsonl(val, path, append=True)
    return path


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation results: CSV, JSON lines, a JSON array, or an object that holds the rows as data, items, results or records."""
    if path.lower().endswith((".jsonl", ".csv")):
        df = read_file(spark, path)
        return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns})
    df = spark.read.option("multiLine", True).json(path)
    for c in ("data", "items", "results", "records"):
        if c in df.columns and dict(df.dtypes)[c].startswith("array<struct"):
            return df.select(F.explode(c).alias("r")).select("r.*")
    return df


def metrics_long(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, metric, value) of the numeric columns of a result table."""
    numeric = [c for c, t in df.dtypes if c not in keys and t in ("int", "bigint", "double", "float")]
    return df.select(*keys, F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in numeric]), F.array(*[F.col(c).cast("double") for c in numeric]))).alias("metric", "value")).where(F.col("value").isNotNull())


def report(df: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """A table with one line for each row key and one column for each column key."""
    return df.groupBy(row).pivot(column).agg(F.avg(value)).orderBy(row)


def markdown(df: DataFrame) -> str:
    """A small report as a Markdown table."""
    rows = [df.columns, ["---"] * len(df.columns), *[["" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v) for v in r] for r in df.collect()]]
    return "\n".join("| " + " | ".join(r) + " |" for r in rows)
