"""Structured Streaming variants of the POS and clickstream jobs."""
