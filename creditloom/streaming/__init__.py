"""Structured Streaming forms of the transaction mart and drift monitoring."""
