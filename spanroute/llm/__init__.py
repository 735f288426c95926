"""Operators for preparing text corpora; see README.md for methods and figures."""
