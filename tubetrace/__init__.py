"""Specimen-chain analytics as Spark DataFrame operators."""
