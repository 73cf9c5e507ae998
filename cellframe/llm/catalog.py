"""The registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from cellframe.llm import chat, decontamination, language_id, licenses, mixing, ngram_join, pii, quality, revisits, sharding

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_mixing": mixing.op3_mixing,
    "op4_quality": quality.op4_quality,
    "op5_licenses": licenses.op5_licenses,
    "op6_chat": chat.op6_chat,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_sharding": sharding.op8_sharding,
    "op9_language_id": language_id.op9_language_id,
    "op10_revisits": revisits.op10_revisits,
}

#: The others train models, use hashes that DuckDB lacks, or scan with hundreds of rules; tests/llm has brute force for them.
ORACLES = {
    "op2_ngram_join": ngram_join.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op4_quality": quality.ORACLE,
    "op10_revisits": revisits.ORACLE,
}
