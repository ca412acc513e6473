"""Training-data operators: decontamination, mixing, language, secrets, token files, duplicates, quality, pages."""
