"""Reading and writing: pairs, splits, vocabularies, token tables."""
