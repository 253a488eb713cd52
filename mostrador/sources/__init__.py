"""Readers and writers: delimited and JSON extracts, the monthly fact table, the load log."""
