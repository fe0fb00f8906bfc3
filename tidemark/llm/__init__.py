"""Operators for building training data: scoring, mixing, packing, joins, sharding, redaction, rules, extraction."""
