"""Operators of a training-data pipeline over documents; nothing else in the package imports them."""
