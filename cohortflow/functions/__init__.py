"""Column expressions: cleaning, parsing and classifying cells."""
