"""Omnichannel retail stock warehouse on PySpark."""
