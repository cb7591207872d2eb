"""Training-data operators: language, quality, duplicates, personal data, archives, packing, token ids."""
