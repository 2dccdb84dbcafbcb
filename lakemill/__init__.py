"""Layered retail warehouse jobs on PySpark: extract, clean, merge, measure."""
