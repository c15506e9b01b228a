"""Operators of a training-data pipeline: scoring, scanning, searching, de-duplication, packing, tokenisation."""
