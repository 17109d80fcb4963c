"""Operators of a training-data pipeline: scoring, extraction, de-duplication, mixing, output."""
