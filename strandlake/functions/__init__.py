"""Scalar functions as Spark columns, and their registration as SQL functions."""
