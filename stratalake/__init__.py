"""Layered (bronze, silver, gold) analytics for PySpark."""
