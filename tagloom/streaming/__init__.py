"""Structured Streaming: sources, windowed counts, per-batch top-K."""
