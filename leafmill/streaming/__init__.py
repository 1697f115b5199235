"""Structured Streaming versions of the corpus job and the ledger."""
