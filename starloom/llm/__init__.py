"""Training-data operators: fingerprints, deduplication, packing, scans, chat, tokens, quality, pages."""
