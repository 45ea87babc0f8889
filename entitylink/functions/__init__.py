"""Column expressions: text normalisation, tokens, similarities."""
