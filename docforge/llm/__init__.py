"""Operators for preparing training corpora."""
