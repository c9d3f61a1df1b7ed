"""Quern: relational evidence, ranking and question building on PySpark DataFrames."""

__version__ = "0.1.0"
