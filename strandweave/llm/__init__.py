"""Training-data operators: chat formatting, search, deduplication, quality, tokens, secrets, shards, mixtures."""
