"""Retail sales marts on Spark: landing CSV files in, marts and monthly tables out."""
