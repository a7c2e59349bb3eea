"""Operators of a training-data pipeline (near-dedup, tokenising, extraction,
quality, decontamination, sharding, substring dedup, classifiers, PII).

Nothing else in the library imports this package.
"""
