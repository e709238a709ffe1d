"""Reusable PySpark data operators and the jobs composed from them."""
