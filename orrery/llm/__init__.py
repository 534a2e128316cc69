"""Operators that a training-data pipeline needs: licence scans, archives, URL rules, dedup, mixing, PII, quality, tokens."""
