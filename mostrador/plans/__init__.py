"""Whole flows: the two-pass load into the fact table and the in-memory flow."""
