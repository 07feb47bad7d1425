"""Readers and writers of the input, check and result tables."""
