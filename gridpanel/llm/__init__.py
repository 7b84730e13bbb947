"""Operators of a training-data pipeline: tokenisation, filtering, near duplicates, search, archives, sharding, formatting."""
