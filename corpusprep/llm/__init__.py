"""Operators of a training-data pipeline: near-duplicates, tokens, scores, fingerprints, formats."""
