"""A corpus pipeline of five stages, each one operator of quarry.llm.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the docs of the next stage.  All but the last return the columns of documents.

All stages take nulls in any column, empty and very long texts, repeated rows, empty tables and further columns of
any name (but those that begin with two underscores); such columns keep their values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, jaccard, mixing, secrets, toxicity
from quarry.llm.cluster import removed, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the labels of the training folds are read from sf_dir.

    Null and empty texts have no votes and stay; repeated rows stay or go together.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity_scores(docs, labels, names=("__score", "__toxic", "__held")).where("__toxic = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked texts, that of least doc_id; those without words or id stay."""
    return jaccard.deduplicated(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its secrets replaced by a mark; n_chars follows the new text (null for a null text)."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by weight: documents as often as they are drawn, shuffled within the parts of each shard.

    Null texts count no word and may be drawn; a null source is a source of its own.
    """
    aside = {c: f"__own_{c}" for c in ("shard", "position") if c in docs.columns}
    return mixing.mixed(docs.withColumnsRenamed(aside)).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the token ids of every document of the mix, with their number and the digests of a round trip.

    Null and empty texts have no ids.
    """
    return bpe.round_trip(docs, ["doc_id", "lang", "source"], with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("byte_bpe", encode_texts),
]

#: SQL can express neither the classifier nor the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each stage's rows go through Parquet in the shared folder, until the next has read them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    removed(spark, folder, now=False)
    before = None
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        path = f"{folder}/{i}-{name}"
        out.write.parquet(path)
        if before:
            removed(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
