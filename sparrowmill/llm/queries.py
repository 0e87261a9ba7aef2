"""The opN queries and their SQL; the pipeline is added when corpus_pipeline.py is there."""

from __future__ import annotations

import importlib

#: query name -> (module, whether it has SQL)
OPS = {
    "op1_quality": ("quality", False),
    "op2_exact_dedup": ("exact_dedup", True),
    "op3_suffix_dedup": ("suffix_dedup", False),
    "op4_chat_format": ("chat_format", True),
    "op5_decontaminate": ("decontaminate", True),
    "op6_bpe": ("bpe", False),
    "op7_toxicity": ("toxicity", False),
    "op8_license_scan": ("license_scan", False),
    "op9_hmm_lm": ("hmm_lm", False),
    "op10_jaccard_join": ("jaccard_join", False),
    "op11_minhash": ("minhash", True),
    "op12_alignment": ("alignment", False),
    "op13_chat_repair": ("chat_repair", False),
}


def queries() -> dict:
    return {k: getattr(importlib.import_module(f"{__package__}.{m}"), k) for k, (m, _) in OPS.items()}


def oracle_sql() -> dict:
    return {k: importlib.import_module(f"{__package__}.{m}").SQL for k, (m, sql) in OPS.items() if sql}
