"""Pitchline: a PySpark batch engine that turns raw fixture files into one verified table."""
