"""The registered queries of this subpackage and their DuckDB twins.

Queries without SQL (see README) are tested against brute force in tests/llm.
"""

from __future__ import annotations

from tessera.llm import (
    conversations,
    decontaminate,
    language,
    lm,
    nearest,
    neighbours,
    quality,
    sentencepieces,
    sharding,
    simhash,
    substrings,
    token_files,
    whitening,
)

QUERIES = {
    "op1_deleted_interpolation": lm.op1_deleted_interpolation,
    "op2_token_files": token_files.op2_token_files,
    "op3_sentencepiece": sentencepieces.op3_sentencepiece,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_substring_dedup": substrings.op5_substring_dedup,
    "op6_quality": quality.op6_quality,
    "op7_nn_descent": neighbours.op7_nn_descent,
    "op8_simhash": simhash.op8_simhash,
    "op9_language": language.op9_language,
    "op10_sharding": sharding.op10_sharding,
    "op11_prefix_trie": conversations.op11_prefix_trie,
    "op12_shifted_curves": nearest.op12_shifted_curves,
    "op13_whitening": whitening.op13_whitening,
}

SQL = {
    "op4_decontamination": decontaminate.SQL,
    "op5_substring_dedup": substrings.SQL,
}
