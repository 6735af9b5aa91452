"""lanecost: transfer-price corridor analytics as composable Spark DataFrame operators.

Every operator takes and returns DataFrames; column names, keys, thresholds and
reference values are parameters with defaults, so the operators apply to any table
of the same shape.
"""

__version__ = "0.1.0"
