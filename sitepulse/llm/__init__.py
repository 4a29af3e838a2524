"""Operators for preparing training corpora, with their queries and SQL twins."""

from sitepulse.llm import (
    audit, exact, langid, licenses, lines, mixing, packing, simhash, spelling, suffix, tokens, topk,
    toxicity,
)
from sitepulse.llm.common import on_workers

_QUERIES = {
    "op1_simhash_dedup": simhash.op1_simhash_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_exact_dedup": exact.op3_exact_dedup,
    "op4_topk_search": topk.op4_topk_search,
    "op5_source_mix": mixing.op5_source_mix,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_packing": packing.op7_packing,
    "op8_suffix_dedup": suffix.op8_suffix_dedup,
    "op9_line_dedup": lines.op9_line_dedup,
    "op10_token_counts": tokens.op10_token_counts,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_language_id": langid.op12_language_id,
    "op13_filter_audit": audit.op13_filter_audit,
}
QUERIES = {name: on_workers(fn) for name, fn in _QUERIES.items()}

CHECKS = {
    "op3_exact_dedup": exact.SQL,
    "op4_topk_search": topk.SQL,
    "op5_source_mix": mixing.SQL,
    "op6_license_scan": licenses.SQL,
    "op13_filter_audit": audit.SQL,
}
