"""The queries of this subpackage, and their SQL where there is one."""

from __future__ import annotations

from . import exact_topk, language_id, license_notices, merkle_fixity, mixing, near_dedup, packing, quality_rules, secrets, suffix_dedup, token_alignment, url_filters, vector_codes

QUERIES = {
    "op1_url_filters": url_filters.op1_url_filters,
    "op2_exact_topk": exact_topk.op2_exact_topk,
    "op3_language_id": language_id.op3_language_id,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_poisson_mixing": mixing.op6_poisson_mixing,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_merkle_fixity": merkle_fixity.op8_merkle_fixity,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_token_alignment": token_alignment.op11_token_alignment,
    "op12_license_scan": license_notices.op12_license_scan,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}
ORACLES = {
    "op1_url_filters": url_filters.ORACLE_SQL,
    "op2_exact_topk": exact_topk.ORACLE_SQL,
    "op4_quality_rules": quality_rules.ORACLE_SQL,
    "op6_poisson_mixing": mixing.ORACLE_SQL,
    "op7_near_dedup": near_dedup.ORACLE_SQL,
    "op8_merkle_fixity": merkle_fixity.ORACLE_SQL,
    "op13_vector_codes": vector_codes.ORACLE_SQL,
}
