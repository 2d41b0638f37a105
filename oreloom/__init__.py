"""Oreloom: archive mining and corpus preparation on PySpark."""
