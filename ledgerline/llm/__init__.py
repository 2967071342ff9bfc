"""Operators for building training corpora (imported by nothing else in the library)."""
