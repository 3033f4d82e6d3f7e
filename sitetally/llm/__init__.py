"""Training-data operators: language-model scores, extraction, tokens, language, licences, quality, duplicates, packing."""
