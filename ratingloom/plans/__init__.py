"""Splits, metrics and experiments composed from the operators."""
