"""Joins that the data pipelines need beyond plain ones."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.arrays import cosine


def lookup_last(df: DataFrame, other: DataFrame, key: str, order: str) -> DataFrame:
    """Inner join with the last row of other for each key."""
    cols = [c for c in other.columns if c not in (key, order)]
    last = other.groupBy(key).agg(F.max(F.struct(F.col(order), *[F.col(c) for c in cols])).alias("__x")).select(key, *[F.col(f"__x.{c}").alias(c) for c in cols])
    return df.join(last, key)


def row_digest(df: DataFrame, *without: str) -> Column:
    """md5 of the row as Python's json.dumps(row, sort_keys=True) writes it, some columns left out."""

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        return rows.map(lambda t: hashlib.md5(json.dumps(json.loads(t), sort_keys=True).encode()).hexdigest())

    return run(F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in without]), {"ignoreNullFields": "false"}))


def cache_misses(df: DataFrame, cache: DataFrame, n: int) -> DataFrame:
    """Rows whose digest has fewer than n cached choices; cache has (digest, choices)."""
    full = cache.groupBy("digest").agg(F.sum(F.size("choices")).alias("n")).where(F.col("n") == n)
    return df.withColumn("digest", row_digest(df)).join(full, "digest", "left_anti")


def route(df: DataFrame, routes: DataFrame, tag: str) -> DataFrame:
    """Join with the one route of each tag; rows without any, and tags with several, are an error at run time."""
    one = routes.groupBy(tag).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in routes.columns if c != tag])
    met = df.join(one, tag, "left")
    ok = F.when(F.col("__n") == 1, True).otherwise(F.raise_error(F.concat(F.lit("no single route for "), F.coalesce(F.col(tag).cast("string"), F.lit("null")))).cast("boolean"))
    return met.where(ok).drop("__n")


def zipped(left: DataFrame, right: DataFrame, order: str) -> DataFrame:
    """Rows that stand at the same place in both."""
    from quarry.operators.preprocess import ordinal

    a, b = ordinal(left, order, name="__at"), ordinal(right, order, name="__at").drop(order)
    return a.join(b, "__at").drop("__at")


def existing(df: DataFrame, listing: DataFrame, path: str) -> DataFrame:
    """Rows whose path is in the listing."""
    return df.join(listing.select(F.col("path").alias(path)).distinct(), path, "left_semi")


def all_existing(df: DataFrame, listing: DataFrame, paths: str, row: str) -> DataFrame:
    """Rows all of whose paths are in the listing; rows without paths stay."""
    missing = df.select(row, F.explode(paths).alias("path")).join(listing.select("path").distinct(), "path", "left_anti").select(row).distinct()
    return df.join(missing, row, "left_anti")


def similarity_blocks(left: DataFrame, right: DataFrame, left_id: str, right_id: str, vector: str, block: str) -> DataFrame:
    """Cosine similarities of all pairs within a block."""
    a = left.select(block, left_id, F.col(vector).alias("__a"))
    b = right.select(block, right_id, F.col(vector).alias("__b"))
    return a.join(b, block).select(block, left_id, right_id, cosine(F.col("__a"), F.col("__b")).alias("similarity"))
