"""Filings, news, price and macro analytics as plain PySpark functions."""
