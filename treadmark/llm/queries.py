"""The queries of this package by name, and those of them that SQL can express as DuckDB SQL."""

from __future__ import annotations

from treadmark.llm import (
    jaccard_join, metric_search, mix, prefix_trie, quality_net, quality_rules, seating_lm, secret_scan, sentence_pieces, subword_toxicity,
    target_resampling, token_counts, url_filter,
)

QUERIES = {
    "op1_pareto_mix": mix.op1_pareto_mix,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op5_sentence_pieces": sentence_pieces.op5_sentence_pieces,
    "op6_jaccard_join": jaccard_join.op6_jaccard_join,
    "op7_seating_lm": seating_lm.op7_seating_lm,
    "op8_metric_search": metric_search.op8_metric_search,
    "op9_quality_net": quality_net.op9_quality_net,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_subword_toxicity": subword_toxicity.op11_subword_toxicity,
    "op12_target_resampling": target_resampling.op12_target_resampling,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLE_SQL = {
    "op1_pareto_mix": mix.ORACLE,
    "op8_metric_search": metric_search.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
    "op12_target_resampling": target_resampling.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
