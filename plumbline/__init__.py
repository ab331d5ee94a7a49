"""Governed metrics on Spark: trusted data products built and served with DataFrames."""
