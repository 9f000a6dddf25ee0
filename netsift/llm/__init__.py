"""Training-data operators: quality rules, language id, source mixing, decontamination,
secret scans, toxicity, SimHash near-dedup, chat formatting, licence scans, line dedup.

Nothing else in the library imports this package. ``queries.REGISTRY`` holds the
registered queries; ``corpus_pipeline.py`` at the repository top chains five operators.
"""
