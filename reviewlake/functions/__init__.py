"""Column expressions: text, pseudonyms, decisions, calendar."""
