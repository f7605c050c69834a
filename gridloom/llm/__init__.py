"""Training-data operators over text tables: scoring, mixing, counting, privacy, deduplication, quality."""
