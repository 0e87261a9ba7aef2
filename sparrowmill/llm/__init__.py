"""Training-data operators: dedup, decontamination, tokens, scoring."""
