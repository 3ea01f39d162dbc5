"""Queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from . import (blocknames, decontaminate, digestcache, divergence, grouppack, langid, linejoin, neardup, perspectives,
               regrammar, spellgram, subword, tokenalign)

QUERIES = {
    "op1_exact_dedup": blocknames.op1_exact_dedup,
    "op2_quality": subword.op2_quality,
    "op3_packing": grouppack.op3_packing,
    "op4_line_dedup": linejoin.op4_line_dedup,
    "op5_language": langid.op5_language,
    "op6_token_counts": digestcache.op6_token_counts,
    "op7_token_ids": regrammar.op7_token_ids,
    "op8_chat_perspectives": perspectives.op8_chat_perspectives,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_near_dedup": neardup.op10_near_dedup,
    "op11_token_alignment": tokenalign.op11_token_alignment,
    "op12_quality_rules": divergence.op12_quality_rules,
    "op13_spelling_variants": spellgram.op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": blocknames.OP1_SQL,
    "op4_line_dedup": linejoin.OP4_SQL,
    "op8_chat_perspectives": perspectives.OP8_SQL,
    "op9_decontamination": decontaminate.OP9_SQL,
    "op10_near_dedup": neardup.OP10_SQL,
    "op12_quality_rules": divergence.OP12_SQL,
}
