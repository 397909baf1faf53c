"""Operators for a training-data pipeline: sharding, decontamination, near-dedup,
tokenizers, licence scans, page text, quality, toxicity and secrets.

Nothing outside this subpackage imports it.
"""
