"""Queries of the library on the sample tables, each with the same query in plain SQL."""
