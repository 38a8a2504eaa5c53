"""Operators of a training-data pipeline (packing, extraction, scoring, filters, deduplication).

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when it can be imported.
"""
