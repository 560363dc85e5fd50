"""Building blocks: DataFrame → DataFrame operators and writers."""
