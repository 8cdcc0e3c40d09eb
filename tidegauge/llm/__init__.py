"""Operators of a training-data pipeline: clean-up, de-duplication, scoring, packing and storage of documents."""
