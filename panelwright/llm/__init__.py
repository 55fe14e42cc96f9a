"""Training-data operators: deduplication, filtering, redaction, packing and token accounting."""
