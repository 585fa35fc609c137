"""DataFrame operators: cleaning, reshapes, quality checks, merges, row identities."""
