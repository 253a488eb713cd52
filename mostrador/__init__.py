"""Retail-sales statistics on Spark: clean, enrich, store and summarise sales lines."""
