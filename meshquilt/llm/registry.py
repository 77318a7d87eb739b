"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from . import centroid_clustering, exact_dedup, jaccard_join, language_id, license_scan, mixing, packing, quality_classifier, quality_rules, topk_search, toxicity, url_filters

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_language_id": language_id.op2_language_id,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "quality_rules_ablation": quality_rules.quality_rules_ablation,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_mixing_sources": mixing.op5_mixing_sources,
    "op6_quality_classifier": quality_classifier.op6_quality_classifier,
    "op7_url_filters": url_filters.op7_url_filters,
    "op8_topk_search": topk_search.op8_topk_search,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_license_scans": license_scan.op10_license_scans,
    "op11_exact_dedup": exact_dedup.op11_exact_dedup,
    "op12_centroid_clustering": centroid_clustering.op12_centroid_clustering,
}
ORACLES = {
    "op3_quality_rules": quality_rules.SQL,
    "quality_rules_ablation": quality_rules.ABLATION_SQL,
    "op5_mixing_sources": mixing.SQL,
    "op7_url_filters": url_filters.SQL,
    "op8_topk_search": topk_search.SQL,
    "op10_license_scans": license_scan.SQL,
    "op11_exact_dedup": exact_dedup.SQL,
    "op12_centroid_clustering": centroid_clustering.SQL,
}
