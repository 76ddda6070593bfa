"""Operators for training data: tokens, shards, duplicates, licenses, search, languages, personal data, packing, quality."""
