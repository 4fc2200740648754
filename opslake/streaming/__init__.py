"""Streaming: incremental landing of new flight files (Structured Streaming)."""
