"""Training-data operators: deduplication, extraction, formatting, archives,
quality, decontamination, language identification, licence scans and packing."""
