"""The operators' queries by name, and the SQL of those that DuckDB can express."""

from __future__ import annotations

from . import chat, divergence, langid, minhash, mixing, ngram_join, pieces, quality_rules, repeats, secrets, token_counts, topk, whitening

QUERIES = {
    "op1_quality_rules": quality_rules.op1,
    "op2_exact_top_k": topk.op2,
    "op3_sentencepiece": pieces.op3,
    "op4_suffix_array_dedup": repeats.op4,
    "op5_secret_scan": secrets.op5,
    "op6_chat_format": chat.op6,
    "op7_source_mixing": mixing.op7,
    "op8_ngram_jaccard_join": ngram_join.op8,
    "op9_token_counts": token_counts.op9,
    "op10_language_id": langid.op10,
    "op11_source_divergence": divergence.op11,
    "op12_minhash_dedup": minhash.op12,
    "op13_embedding_whitening": whitening.op13,
}
ORACLES = {
    "op1_quality_rules": quality_rules.OP1_SQL,
    "op2_exact_top_k": topk.OP2_SQL,
    "op6_chat_format": chat.OP6_SQL,
    "op8_ngram_jaccard_join": ngram_join.OP8_SQL,
    "op11_source_divergence": divergence.OP11_SQL,
    "op12_minhash_dedup": minhash.OP12_SQL,
}
