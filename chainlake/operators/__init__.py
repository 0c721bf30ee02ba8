"""Operators over DataFrames: protocol plugins, decoding, routing, enrichment, deduplication."""
