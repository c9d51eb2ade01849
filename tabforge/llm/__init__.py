"""Training-data operators: resharding, deduplication, quality, filtering, packing, extraction and archives."""
