"""Training-data operators: packing, URL filtering, deduplication, extraction, language and token work."""
