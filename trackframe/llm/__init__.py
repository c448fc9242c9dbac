"""Training-data operators: dedup, mixing, licences, token output, quality, secrets, toxicity, decontamination."""
