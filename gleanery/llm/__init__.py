"""Operators for text corpora of language-model training. Nothing outside this folder imports it."""
