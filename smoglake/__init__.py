"""smoglake: sensor analytics as Spark DataFrame and Structured Streaming operators.

Subpackages: ``sources`` (CSV, JSON payloads, Kafka, parquet), ``operators``
(cleaning, reshape, quality, merge, keys), ``functions`` (label expressions),
``plans`` (documents, analytics, graph, presentation), ``streaming``.
``config.SensorConfig`` parameterises every operator; ``jobs`` and
``python -m smoglake`` run the pipeline stages; ``catalog`` holds the
registered queries.
"""
