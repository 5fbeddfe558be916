"""Store-operations analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing is collected
except single-row scalars and fitted model coefficients.
"""
