"""Operators a training-data pipeline needs, one module each (see README)."""
