"""Column functions: strings, name similarity, dates and distances."""
