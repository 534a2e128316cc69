"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from orrery.llm import byte_bpe, divergence_audit, exact_dedup, filter_audit, license_scan, line_dedup, mixing, packed_tokens, pii, quality, simhash, url_filter, warc

MODULES = [license_scan, warc, url_filter, simhash, mixing, pii, line_dedup, quality, exact_dedup, byte_bpe, divergence_audit, filter_audit, packed_tokens]


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
