"""Registered queries of the training-data operators, and their SQL where SQL expresses them."""

from __future__ import annotations

from siftspark.llm import alignment, decontamination, dominance, embedding_dedup, jaccard_join, language, licenses, packing, pii, quality, substring_dedup, toxicity, url_filters

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_embedding_dedup": embedding_dedup.op3_embedding_dedup,
    "op4_decontamination": decontamination.op4_decontamination,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_packing": packing.op6_packing,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_url_filters": url_filters.op8_url_filters,
    "op9_language": language.op9_language,
    "op10_licenses": licenses.op10_licenses,
    "op11_alignment": alignment.op11_alignment,
    "op12_dominance": dominance.op12_dominance,
    "op13_pii": pii.op13_pii,
}

ORACLES = {"op3_embedding_dedup": embedding_dedup.ORACLE, "op5_jaccard_join": jaccard_join.ORACLE, "op8_url_filters": url_filters.ORACLE, "op12_dominance": dominance.ORACLE}
