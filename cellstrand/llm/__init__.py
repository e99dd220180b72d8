"""Training-data operators: scoring, deduplication, search and tokenisation of text tables."""
