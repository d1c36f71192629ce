"""contrail: flight telemetry analytics on Spark.

Subpackages: ``functions`` (column expressions), ``sources`` (wire codec,
tables, test-table mapping), ``operators`` (silver, features, airports,
gold, reports, serving, classifier), ``streaming`` (stream jobs),
``plans`` (registered queries and their DuckDB SQL).
"""

__version__ = "0.1.0"
