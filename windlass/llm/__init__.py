"""Operators of a training-data pipeline: dedup, extraction, scoring, packing,
search, filtering and tokenising of text corpora, each as Spark jobs.

Nothing else in ``windlass`` imports this subpackage. ``queries`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five of
them.
"""
