"""Warehouse operators, each a plain DataFrame -> DataFrame function."""
