"""Structured Streaming stages: file/topic sources, clean, running averages, sinks."""
