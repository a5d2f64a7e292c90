"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

#: query name: module
MODULES = {
    "op1_language_id": "langid",
    "op2_token_output": "token_output",
    "op3_quality_classifier": "quality",
    "op4_benchmark_decontamination": "decontaminate",
    "op5_secret_scan": "secrets",
    "op6_exact_top_k": "hamming",
    "op7_substring_dedup": "line_dedup",
    "op8_personal_data": "pii",
    "op9_best_fit_packing": "packing",
    "op10_ngram_jaccard_join": "ngram_join",
}


def queries() -> dict:
    out = {name: getattr(import_module(f".{module}", __package__), name) for name, module in MODULES.items()}
    out["pipeline"] = import_module("corpus_pipeline").run
    return out


def oracle_sql() -> dict[str, str]:
    from .hamming import OP6_SQL
    from .line_dedup import OP7_SQL

    return {"op6_exact_top_k": OP6_SQL, "op7_substring_dedup": OP7_SQL}
