"""Incremental (streaming) curation."""
