"""Quire: page-level document dataflow on PySpark DataFrames."""
