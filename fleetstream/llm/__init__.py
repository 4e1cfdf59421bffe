"""Operators of a training-data pipeline: filtering, deduplication, scans, counts and mixing."""
