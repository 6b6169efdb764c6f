"""Filters, sampling, joins, cleaning and code lookup on DataFrames."""
