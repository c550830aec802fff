"""Training-data operators: extraction, tokenising, dedup, language, quality, sharding, LM, decontamination, search."""
