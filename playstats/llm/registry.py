"""The queries of this subpackage by name, and their DuckDB SQL where SQL can express them."""

from playstats.llm import q_bpe, q_clustering, q_exact_dedup, q_jaccard_join, q_license_scan, q_line_dedup, q_lm_scoring, q_merkle, q_mixing, q_quality_classifier, q_quality_rules, q_sharding, q_url_filter

QUERIES = {
    "op1_url_filter": q_url_filter.op1_url_filter,
    "op2_lm_scoring": q_lm_scoring.op2_lm_scoring,
    "op3_license_scan": q_license_scan.op3_license_scan,
    "op4_ngram_jaccard_join": q_jaccard_join.op4_ngram_jaccard_join,
    "op5_quality_classifier": q_quality_classifier.op5_quality_classifier,
    "op6_quality_rules": q_quality_rules.op6_quality_rules,
    "op7_byte_bpe": q_bpe.op7_byte_bpe,
    "op8_line_dedup": q_line_dedup.op8_line_dedup,
    "op9_exact_dedup": q_exact_dedup.op9_exact_dedup,
    "op10_mixing": q_mixing.op10_mixing,
    "op11_merkle_manifest": q_merkle.op11_merkle_manifest,
    "op12_sharding": q_sharding.op12_sharding,
    "op13_centroid_clustering": q_clustering.op13_centroid_clustering,
}

SQL = {
    "op1_url_filter": q_url_filter.SQL,
    "op4_ngram_jaccard_join": q_jaccard_join.SQL,
    "op6_quality_rules": q_quality_rules.SQL,
    "op8_line_dedup": q_line_dedup.SQL,
    "op9_exact_dedup": q_exact_dedup.SQL,
    "op10_mixing": q_mixing.SQL,
    "op11_merkle_manifest": q_merkle.SQL,
    "op12_sharding": q_sharding.SQL,
    "op13_centroid_clustering": q_clustering.SQL,
}
