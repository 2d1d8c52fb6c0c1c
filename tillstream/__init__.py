"""Retail sales analytics on Spark: typed topics, rate conversion, running totals."""
