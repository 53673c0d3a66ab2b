"""Operators of a training-data pipeline (deduplication, quality, mixing,
packing, tokens, archives).  Nothing else in the library imports this
subpackage."""
