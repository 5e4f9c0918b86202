"""Queries of the training-data operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (audit, collocations, decontaminate, embeddings, minhash, mixing, pii, quality, secrets, sharding,
               substrings, tokencounts, urls)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_spaced_seeds": decontaminate.op1_spaced_seeds,
        "op2_pigeonhole": embeddings.op2_pigeonhole,
        "op3_superminhash": minhash.op3_superminhash,
        "op4_weak_supervision": pii.op4_weak_supervision,
        "op5_fm_index": substrings.op5_fm_index,
        "op6_stratified_shards": sharding.op6_stratified_shards,
        "op7_entropy_windows": secrets.op7_entropy_windows,
        "op8_url_rules": urls.op8_url_rules,
        "op9_quality_trees": quality.op9_quality_trees,
        "op10_block_mix": mixing.op10_block_mix,
        "op11_token_counts": tokencounts.op11_token_counts,
        "op12_filter_audit": audit.op12_filter_audit,
        "op13_collocations": collocations.op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_spaced_seeds": decontaminate.ORACLE,
        "op2_pigeonhole": embeddings.ORACLE,
        "op3_superminhash": minhash.ORACLE,
        "op5_fm_index": substrings.ORACLE,
        "op12_filter_audit": audit.ORACLE,
        "op13_collocations": collocations.ORACLE,
    }
