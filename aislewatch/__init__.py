"""Retail catalogue monitoring on Spark: page captures in, product observations and image matches out."""
