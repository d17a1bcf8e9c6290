"""Operators for building training corpora for language models."""
