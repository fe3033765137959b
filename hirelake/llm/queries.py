"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import alignment, ann, chat, divergence, language_id, line_dedup, mixing, near_dup, packing, sharding, simhash, toxicity, url_filter

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_packing": packing.query,
    "op3_url_filter": url_filter.query,
    "op4_simhash": simhash.query,
    "op5_line_dedup": line_dedup.query,
    "op6_near_dup": near_dup.query,
    "op7_chat": chat.query,
    "op8_ann": ann.query,
    "op9_language_id": language_id.query,
    "op10_toxicity": toxicity.query,
    "op11_alignment": alignment.query,
    "op12_divergence": divergence.query,
    "op13_sharding": sharding.query,
}

ORACLE: dict[str, str] = {
    "op1_mixing": mixing.SQL,
    "op5_line_dedup": line_dedup.SQL,
    "op7_chat": chat.SQL,
    "op12_divergence": divergence.SQL,
}
