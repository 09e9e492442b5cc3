"""Training-data operators: contamination, language, duplicates, tokens, licences, archives, toxicity, secrets, quality."""
