"""Operators: parameterised DataFrame compositions (no Python UDFs)."""
