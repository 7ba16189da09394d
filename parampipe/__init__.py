"""Parameterised extract, incremental load and SQL steps on Spark."""
