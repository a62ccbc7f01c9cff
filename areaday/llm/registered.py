"""The queries of this subpackage over the given tables, each with its SQL or ``None``."""

from __future__ import annotations

from areaday.llm import queries as q

QUERIES = {
    "op1_toxicity": (q.op1_toxicity, None),
    "op2_best_fit_packing": (q.op2_best_fit_packing, None),
    "op3_lm_scoring": (q.op3_lm_scoring, None),
    "op4_quality": (q.op4_quality, None),
    "op5_decontamination": (q.op5_decontamination, q.OP5_SQL),
    "op6_jaccard_join": (q.op6_jaccard_join, q.OP6_SQL),
    "op7_exact_dedup": (q.op7_exact_dedup, q.OP7_SQL),
    "op8_line_dedup": (q.op8_line_dedup, None),
    "op9_url_filters": (q.op9_url_filters, q.OP9_SQL),
    "op10_pii": (q.op10_pii, None),
    "op11_ranked_search": (q.op11_ranked_search, q.OP11_SQL),
    "op12_quality_rules": (q.op12_quality_rules, q.OP12_SQL),
    "op13_periodic_runs": (q.op13_periodic_runs, None),
}
