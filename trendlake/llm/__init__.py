"""Operators for preparing training data: filters, deduplication, decontamination,
archives, token counts and mixing.  Nothing outside this package imports it."""
