"""Operators for a training-data pipeline over tables of texts. Nothing outside this subpackage imports it."""
