"""Operators for large-scale text corpora (training-data preparation).

Nothing outside this subpackage imports it.  Every operator takes DataFrames
and returns DataFrames; documents never pass through the driver, and numpy or
Arrow code only runs inside Spark tasks, on one bounded batch at a time.
"""
