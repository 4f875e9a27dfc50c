"""Corpus, dictionary and matrix readers."""
