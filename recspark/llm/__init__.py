"""Operators of a training-data pipeline (mixing, packing, deduplication, language and
quality models, fingerprints, token counts).  Nothing outside this package imports it."""
