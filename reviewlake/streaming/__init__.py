"""Streams: the idempotent ingest of files, and endpoint latencies kept in state."""
