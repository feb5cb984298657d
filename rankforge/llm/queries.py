"""Queries and DuckDB texts of the corpus operators."""

from __future__ import annotations

from rankforge.llm import (chat_format, embeddings, exact_dedup, jaccard_join, licenses, mixing, packing, pitman_yor,
                           quality, resampling, substring_dedup, suffix_dedup, whitening)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_suffix_array_dedup": suffix_dedup.op2_suffix_array_dedup,
    "op3_ngram_jaccard_join": jaccard_join.op3_ngram_jaccard_join,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op5_quality_classifier": quality.op5_quality_classifier,
    "op6_pitman_yor_scores": pitman_yor.op6_pitman_yor_scores,
    "op7_embedding_near_dedup": embeddings.op7_embedding_near_dedup,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_pack_sequences": packing.op10_pack_sequences,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_chat_format": chat_format.op12_chat_format,
    "op13_importance_resampling": resampling.op13_importance_resampling,
}

ORACLE = {
    "op1_mix_sources": mixing.SQL,
    "op3_ngram_jaccard_join": jaccard_join.SQL,
    "op4_substring_dedup": substring_dedup.SQL,
    "op7_embedding_near_dedup": embeddings.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op9_license_scan": licenses.SQL,
    "op12_chat_format": chat_format.SQL,
    "op13_importance_resampling": resampling.SQL,
}
