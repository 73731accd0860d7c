"""Statute network analytics expressed as Spark DataFrame operators."""
