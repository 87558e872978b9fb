"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from tripflow.llm import (
    chat, embeddings, langid, mixing, neardup, packing, pii, prefixes, quality, spelling, substrings, suffixes, toxicity,
)

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_language_id": langid.op2_language_id,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_near_duplicates": neardup.op4_near_duplicates,
    "op5_suffix_dedup": suffixes.op5_suffix_dedup,
    "op6_embedding_near_duplicates": embeddings.op6_embedding_near_duplicates,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_mixing": mixing.op9_mixing,
    "op10_pii": pii.op10_pii,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_prefix_trie": prefixes.op13_prefix_trie,
}

ORACLE = {
    "op1_chat_format": chat.OP1_SQL,
    "op4_near_duplicates": neardup.OP4_SQL,
    "op6_embedding_near_duplicates": embeddings.OP6_SQL,
    "op8_substring_dedup": substrings.OP8_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op10_pii": pii.OP10_SQL,
    "op11_spelling_variants": spelling.OP11_SQL,
    "op13_prefix_trie": prefixes.OP13_SQL,
}
