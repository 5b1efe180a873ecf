"""Training-data operators: deduplication, privacy, chat rendering, quality, mixing, tokens, secrets and page text."""
