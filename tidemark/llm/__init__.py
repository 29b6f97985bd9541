"""Operators over text corpora, vectors and web archives."""
