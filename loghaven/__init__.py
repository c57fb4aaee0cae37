"""loghaven: security-log analytics as PySpark DataFrame operators.

Every operator takes DataFrames and parameters and returns a DataFrame, so the
same function serves a batch table, a micro-batch and, where it holds no state,
an unbounded stream.
"""
