"""Operators for training corpora: fingerprints, mixing, scans, dedup, sharding."""
