"""DataFrame -> DataFrame operators of the model: extraction, cleaning, keys, loads, checks and counts."""
