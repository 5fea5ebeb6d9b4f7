"""The queries of the corpus operators for the driver, and their SQL."""

from __future__ import annotations

from . import decontaminate, importance, jaccard_join, mixing, packing, pitman_yor, quality_rules, secret_scan, shards, substring_dedup, url_filter, whitening

QUERIES = {
    "op1_jaccard_join": jaccard_join.query,
    "op2_substring_dedup": substring_dedup.query,
    "op3_quality_rules": quality_rules.query,
    "op4_decontaminate": decontaminate.query,
    "op5_pitman_yor": pitman_yor.query,
    "op6_sharding": shards.query,
    "op7_secret_scan": secret_scan.query,
    "op8_url_filter": url_filter.query,
    "op9_importance": importance.query,
    "op10_best_fit_packing": packing.query,
    "op11_mixing": mixing.query,
    "op12_whitening": whitening.query,
}

ORACLES = {
    "op1_jaccard_join": jaccard_join.ORACLE,
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op3_quality_rules": quality_rules.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
    "op6_sharding": shards.ORACLE,
    "op8_url_filter": url_filter.ORACLE,
}
