"""Operators for training data: names, entities, ranks, groups, look-alike text, tokens, mixtures and quality of texts."""
