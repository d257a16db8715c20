"""Queries of the operators in this subpackage, and SQL where SQL expresses them."""

from __future__ import annotations

from tidegrid.llm import bpe_codec, chat, decontaminate, exact_dedup, language, line_dedup, minhash, quality, token_counts, toxicity

QUERIES = {
    "op1_exact_dedup": exact_dedup.query,
    "op2_toxicity": toxicity.query,
    "op3_bpe_codec": bpe_codec.query,
    "op4_chat_format": chat.query,
    "op5_line_dedup": line_dedup.query,
    "op6_minhash": minhash.query,
    "op7_quality": quality.query,
    "op8_decontaminate": decontaminate.query,
    "op9_language": language.query,
    "op10_token_counts": token_counts.query,
}
ORACLES = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op6_minhash": minhash.ORACLE,
}
