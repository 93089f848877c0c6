"""Readers for landed raw files, page envelopes, the dimension cache and the curated table."""
