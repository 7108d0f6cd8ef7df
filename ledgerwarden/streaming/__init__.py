"""Structured Streaming ingest of landed feed files."""

from ledgerwarden.streaming.ingest import ingest_transactions, run_on_arrival

__all__ = ["ingest_transactions", "run_on_arrival"]
