"""Vessel-position and terminal analytics expressed as Spark DataFrame operators."""
