"""The registered query of each operator and its SQL, where SQL can say it."""

from __future__ import annotations

from tokloom.llm import (chat, collocations, exact_dedup, fingerprint, line_dedup, lm_score, mixing, ngram_join,
                         packing, pii, search, secret_scan, toxicity)

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_packing": packing.op3_packing,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_chat": chat.op5_chat,
    "op6_fingerprint": fingerprint.op6_fingerprint,
    "op7_lm_score": lm_score.op7_lm_score,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_mixing": mixing.op10_mixing,
    "op11_collocations": collocations.op11_collocations,
    "op12_search": search.op12_search,
    "op13_secrets": secret_scan.op13_secrets,
}

ORACLE = {
    "op1_pii": pii.SQL,
    "op4_line_dedup": line_dedup.SQL,
    "op5_chat": chat.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op10_mixing": mixing.SQL,
    "op11_collocations": collocations.SQL,
    "op12_search": search.SQL,
}
