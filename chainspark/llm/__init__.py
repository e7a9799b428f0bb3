"""Operators of a training-data pipeline: chat text, shards, filters, duplicates, packing, token files.

Nothing outside this subpackage imports it.
"""
