"""The queries of this subpackage, and their answers in SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sieveline.llm import (
    bin_search,
    conversation_repair,
    filter_audit,
    html_extract,
    license_scan,
    line_dedup,
    mixing,
    packing,
    quality_knn,
    quality_rules,
    simhash,
    topk_search,
    toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        mixing.op1_temperature_mixing,
        html_extract.op2_block_labeller,
        quality_rules.op3_bitmask_ledger,
        simhash.op4_tiled_simhash,
        topk_search.op5_dual_cover_tree,
        quality_knn.op6_latent_neighbours,
        toxicity.op7_subword_toxicity,
        license_scan.op8_template_licenses,
        line_dedup.op9_line_runs,
        packing.op10_best_fit_packing,
        filter_audit.op11_bloom_filter_audit,
        bin_search.op12_swap_packing,
        conversation_repair.op13_glr_repair,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_temperature_mixing": mixing.OP1_SQL,
        "op3_bitmask_ledger": quality_rules.OP3_SQL,
        "op5_dual_cover_tree": topk_search.OP5_SQL,
        "op8_template_licenses": license_scan.OP8_SQL,
        "op9_line_runs": line_dedup.OP9_SQL,
        "op11_bloom_filter_audit": filter_audit.OP11_SQL,
    }
