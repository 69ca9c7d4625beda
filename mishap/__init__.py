"""Incident analytics on PySpark: clean, derive, cluster, classify and report."""
