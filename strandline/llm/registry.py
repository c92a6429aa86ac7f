"""Queries of the training-data operators by key, and their SQL."""

from __future__ import annotations

from strandline.llm import best_fit_packing, conversation_repair, decontamination, fingerprints, language_id, language_model, license_scan, near_dedup, prefix_trie, quality, sharding, token_counts, url_filters

_MODULES = (token_counts, quality, decontamination, fingerprints, best_fit_packing, language_model, near_dedup, language_id, url_filters, license_scan, prefix_trie, sharding, conversation_repair)
QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: s for m in _MODULES for k, s in m.ORACLE.items()}
