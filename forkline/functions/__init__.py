"""Column expressions and codecs."""
