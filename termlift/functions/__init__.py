"""Column expressions: tokenising, cleaning, scoring and formatting."""
