"""Registered queries of the operators: name, Spark query and its SQL (or None)."""

from __future__ import annotations

from hirelake.llm import (collocations, conversations, exact_dedup, jaccard, line_dedup, mixing, neighbours, pieces, pii,
                          sharding, substring_dedup, token_counts, toxicity)

_MODULES = {
    "op1_token_counts": token_counts,
    "op2_exact_dedup": exact_dedup,
    "op3_nearest": neighbours,
    "op4_pii": pii,
    "op5_line_dedup": line_dedup,
    "op6_sentencepiece": pieces,
    "op7_jaccard": jaccard,
    "op8_substring_dedup": substring_dedup,
    "op9_mixing": mixing,
    "op10_toxicity": toxicity,
    "op11_collocations": collocations,
    "op12_conversations": conversations,
    "op13_sharding": sharding,
}

QUERIES = {name: (module.run, module.SQL) for name, module in _MODULES.items()}
