"""Operators of a training-data pipeline (see ``catalog`` for their queries)."""
