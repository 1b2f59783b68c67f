"""Imports every operator module, which fills the registry."""

from tillcast.llm import op1_url_filter, op2_quality_rules, op3_ngram_join, op4_license_scan, op5_line_dedup, op6_decontamination, op7_language_id, op8_substring_dedup, op9_best_fit_packing, op10_quality_classifier, op11_sharding, op12_centroid_clustering, op13_importance_resampling  # noqa: F401
from tillcast.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
