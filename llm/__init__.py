"""Training-data operators: decontamination, encoding, quality, joins, search, sharding, mixing, dedup, scoring."""
