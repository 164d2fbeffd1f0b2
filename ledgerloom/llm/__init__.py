"""Operators for training-data text: used by nothing else in the library."""
