"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mailstream.llm import (
    blob_ledger, chunk_prints, host_rules, importance, kd_shards, neardup, oracle, pii, pivotal, prefix_trie, quality,
    transcripts, trie_bpe, url_filter,
)
from mailstream.llm.common import table


def _over(name: str, op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: op(table(spark, sf_dir, name))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": url_filter.op1_url_filter,
        "op2_mixed_sources": _over("documents", pivotal.op2_mixed_sources),
        "op3_chunk_fingerprints": _over("documents", chunk_prints.op3_chunk_fingerprints),
        "op4_near_duplicates": _over("documents", neardup.op4_near_duplicates),
        "op5_quality": quality.op5_quality,
        "op6_bpe": _over("documents", trie_bpe.op6_bpe),
        "op7_chat_turns": transcripts.op7_chat_turns,
        "op8_host_rules": _over("documents", host_rules.op8_host_rules),
        "op9_secrets": _over("documents", blob_ledger.op9_secrets),
        "op10_personal_data": _over("documents", pii.op10_personal_data),
        "op11_importance": importance.op11_importance,
        "op12_kd_shards": _over("documents", kd_shards.op12_shards),
        "op13_prefix_trie": _over("conversations", prefix_trie.op13_prefix_trie),
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
