"""Queries of this subpackage by name, and the SQL that checks those which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import bpe, hmm, jaccard, mixing, quality, rules, secrets, substrings, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": mixing.op1_mix,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_quality_rules": rules.op4_quality_rules,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_substring_dedup": substrings.op6_substring_dedup,
    "op7_hmm_scores": hmm.op7_hmm_scores,
    "op8_byte_bpe": bpe.op8_byte_bpe,
    "op9_jaccard_join": jaccard.op9_jaccard_join,
    "op10_top_k": topk.op10_top_k,
}

ORACLES: dict[str, str] = {
    "op4_quality_rules": rules.OP4_SQL,
    "op6_substring_dedup": substrings.OP6_SQL,
    "op10_top_k": topk.OP10_SQL,
}
