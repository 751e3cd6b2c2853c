"""Freight-trade analytics built from PySpark DataFrame operators."""
