"""Operators for training-data corpora; one module per operator, queries in `queries`."""
