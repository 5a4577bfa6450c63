"""Queries and oracle SQL of the corpus operators."""

from __future__ import annotations

from stratamart.llm import (
    decontamination, hmm, jaccard_join, licences, mixing, pii, prefix_trie, run_index, substring_dedup, toxicity, url_filter, vector_codes,
    vector_lsh,
)

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_mixing": mixing.op2_mixing,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_vector_lsh": vector_lsh.op4_vector_lsh,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_pii": pii.op6_pii,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_licences": licences.op9_licences,
    "op10_hmm": hmm.op10_hmm,
    "op11_run_index": run_index.op11_run_index,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}
# Where SQL can say it; the queries with trained models are tested against brute force in tests/llm.
ORACLE_SQL = {
    "op1_substring_dedup": substring_dedup.OP1_SQL,
    "op2_mixing": mixing.OP2_SQL,
    "op3_url_filter": url_filter.OP3_SQL,
    "op4_vector_lsh": vector_lsh.OP4_SQL,
    "op7_jaccard_join": jaccard_join.OP7_SQL,
    "op8_decontamination": decontamination.OP8_SQL,
    "op9_licences": licences.OP9_SQL,
    "op11_run_index": run_index.OP11_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
    "op13_vector_codes": vector_codes.OP13_SQL,
}
