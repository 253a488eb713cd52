"""Dataset operators: quality, cleaning, features, filters, summaries, request batches."""
