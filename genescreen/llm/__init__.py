"""Operators of a training-data pipeline: scoring, deduplication, labelling and packing of documents."""
