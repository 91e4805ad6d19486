"""Operators of a training-data pipeline: search, filters, dedup, encoding,
language-model scores and archives. Nothing outside this package imports it."""
