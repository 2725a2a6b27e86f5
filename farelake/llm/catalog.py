"""The registered queries of this package, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from farelake.llm import bpe, infill, jaccard, language, mixing, packing, phrases, quality, resampling, scoring, sharding, substrings, topk

_QUERIES = [
    bpe.op1_bpe,
    quality.op2_quality,
    scoring.op3_lm_scoring,
    scoring.op3_lm_scoring_bigrams,
    phrases.op4_fingerprints,
    sharding.op5_sharding,
    topk.op6_topk,
    substrings.op7_substrings,
    jaccard.op8_jaccard,
    language.op9_language,
    packing.op10_packing,
    infill.op11_infill,
    resampling.op12_resampling,
    mixing.op13_mixing,
]


def queries() -> dict:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_lm_scoring": scoring.OP3_SQL,
        "op3_lm_scoring_bigrams": scoring.OP3_BIGRAMS_SQL,
        "op6_topk": topk.OP6_SQL,
        "op7_substrings": substrings.OP7_SQL,
        "op8_jaccard": jaccard.OP8_SQL,
        "op11_infill": infill.OP11_SQL,
        "op12_resampling": resampling.OP12_SQL,
    }
