"""Operators for preparing training data: near copies, search, language, filters, tokens, extraction."""
