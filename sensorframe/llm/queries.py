"""The registered queries of this subpackage and the SQL that some of them are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import class_lm, decontamination, divergence, exact_dedup, mixing, near_dup, quality, secrets, sharding, spelling, token_counts, tool_calls, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity_gbt": toxicity.op1_toxicity_gbt,
        "op2_class_lm": class_lm.op2_class_lm,
        "op3_dart_minhash_dedup": near_dup.op3_dart_minhash_dedup,
        "op4_containment_search": decontamination.op4_containment_search,
        "op5_quality_gbt": quality.op5_quality_gbt,
        "op6_secret_ownership": secrets.op6_secret_ownership,
        "op7_hypergeometric_sharding": sharding.op7_hypergeometric_sharding,
        "op8_pfair_mixing": mixing.op8_pfair_mixing,
        "op9_content_sort_dedup": exact_dedup.op9_content_sort_dedup,
        "op10_tool_call_linking": tool_calls.op10_tool_call_linking,
        "op11_spelling_variants": spelling.op11_spelling_variants,
        "op12_source_divergence": divergence.op12_source_divergence,
        "op13_token_counts": token_counts.op13_token_counts,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_containment_search": decontamination.OP4_SQL,
        "op9_content_sort_dedup": exact_dedup.OP9_SQL,
        "op10_tool_call_linking": tool_calls.OP10_SQL,
        "op11_spelling_variants": spelling.OP11_SQL,
        "op12_source_divergence": divergence.OP12_SQL,
    }
