"""Queries of the operators on their whole tables, and SQL where it can express them."""

from __future__ import annotations

from staffcast.llm import (
    count_min, feistel, licenses, max_score, ownership, packing, page_lines, positional, rule_ensemble, simhash, spelling,
    url_trees, whitening,
)

QUERIES = {
    "op1_rule_ensemble": rule_ensemble.op1_rule_ensemble,
    "op2_count_min": count_min.op2_count_min,
    "op3_sum_of_squares": packing.op3_sum_of_squares,
    "op4_feistel": feistel.op4_feistel,
    "op5_ownership": ownership.op5_ownership,
    "op6_page_lines": page_lines.op6_page_lines,
    "op7_maxscore": max_score.op7_maxscore,
    "op8_url_trees": url_trees.op8_url_trees,
    "op9_positional": positional.op9_positional,
    "op10_simhash": simhash.op10_simhash,
    "op11_q_chunks": spelling.op11_q_chunks,
    "op12_feast": whitening.op12_feast,
    "op13_rare_tokens": licenses.op13_rare_tokens,
}
ORACLES = {"op7_maxscore": max_score.SQL}
