"""Registered queries of the corpus operators and of the pipeline, with their DuckDB SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import embedding_dedup, exact_dedup, filter_audit, fingerprint, hard_negatives, langid, licences, minhash, mixing, packing, substring, suffix_dedup, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_langid_ppm": langid.op1_langid_ppm,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_substring_dedup": substring.op3_substring_dedup,
        "op4_temperature_mixing": mixing.op4_temperature_mixing,
        "op5_warc_index_merge": warc.op5_warc_index_merge,
        "op6_multiset_fingerprint": fingerprint.op6_multiset_fingerprint,
        "op7_suffix_array_dedup": suffix_dedup.op7_suffix_array_dedup,
        "op8_best_fit_packing": packing.op8_best_fit_packing,
        "op9_licence_scan": licences.op9_licence_scan,
        "op10_minhash_near_dedup": minhash.op10_minhash_near_dedup,
        "op11_embedding_near_dedup": embedding_dedup.op11_embedding_near_dedup,
        "op12_filter_audit": filter_audit.op12_filter_audit,
        "op13_hard_negatives": hard_negatives.op13_hard_negatives,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": exact_dedup.OP2_SQL,
        "op3_substring_dedup": substring.OP3_SQL,
        "op4_temperature_mixing": mixing.OP4_SQL,
        "op5_warc_index_merge": warc.OP5_SQL,
        "op9_licence_scan": licences.OP9_SQL,
        "op11_embedding_near_dedup": embedding_dedup.OP11_SQL,
        "op12_filter_audit": filter_audit.OP12_SQL,
        "op13_hard_negatives": hard_negatives.OP13_SQL,
    }
