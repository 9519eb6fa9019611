"""Operators of a training-data pipeline: mixing, sharding, search, quality, chat, dedup, extraction, toxicity, BPE."""
