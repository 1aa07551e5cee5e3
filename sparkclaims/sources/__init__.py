"""Readers and writers for the claim tables."""
