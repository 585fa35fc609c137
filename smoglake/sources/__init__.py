"""Ingest and storage: delimited text, JSON payload codec, Kafka topics, parquet tables."""
