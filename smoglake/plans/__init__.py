"""Query plans over the processed table: documents, profiles, graph, presentation."""
