"""Operators of a training-data pipeline: personal data, toxicity, packing,
line dedup, chat formatting, fingerprints, LM scoring, exact dedup, n-gram
joins and source mixing.  Nothing else in the package imports this one."""
