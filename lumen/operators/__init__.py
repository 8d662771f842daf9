"""Operators: pure DataFrame → DataFrame functions built from Spark functions."""
