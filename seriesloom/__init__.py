"""Spark-first analytics for large collections of financial and economic time series."""
