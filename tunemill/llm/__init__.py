"""Operators for training data: duplicates, contamination, quality, toxicity, licences, tokens, chats."""
