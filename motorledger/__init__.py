"""Dealership ledger analytics expressed as lazy Spark DataFrame operators."""
