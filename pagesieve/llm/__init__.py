"""Operators for training-data pipelines: language, quality, archives, overlap, licences, tokens, URLs."""
