"""Operators for preparing training data from text; nothing outside this package imports it."""
