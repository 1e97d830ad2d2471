"""Scalar expressions: every function takes and returns Columns."""
