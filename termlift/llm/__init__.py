"""Operators for building training data: exact and near deduplication, tokens, scores, rules, shards."""
