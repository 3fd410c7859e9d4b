"""Retail catalogue tracking on Spark: collect, aggregate, count old and new products."""
