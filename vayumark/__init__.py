"""Air-quality index analytics on Spark DataFrames.

Layers, from the bottom up: ``functions`` (column helpers), ``sources`` (reading
payloads, lake and lookup tables), ``operators`` (one DataFrame transformation
each) and ``plans`` (operators put together: building tables, auditing them,
report data sets).
"""

__version__ = "0.1.0"
