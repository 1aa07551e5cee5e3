"""Whole reports and the batch load, composed from the operators."""
