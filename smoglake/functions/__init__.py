"""Column expressions for labels and small literal lookup tables."""
