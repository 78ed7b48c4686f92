"""Hourly power-market analytics expressed as Spark DataFrame functions."""
