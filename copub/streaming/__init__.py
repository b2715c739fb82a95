"""Structured Streaming: incremental ego counts over arriving export files."""
