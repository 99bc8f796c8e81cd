"""Training-data operators: scoring, deduplication, sharding, packing and scans of a text corpus."""
