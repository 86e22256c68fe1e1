"""Training-data operators: text quality, near duplicates, secrets, tokens, packing, urls, vectors, chat pairs."""
