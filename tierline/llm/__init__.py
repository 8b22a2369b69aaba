"""Operators of a training-data pipeline, each one module. Nothing else in the library imports them."""
