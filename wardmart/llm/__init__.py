"""Operators for preparing training data: text, tokens, conversations and embeddings."""
