"""terroir: composable Spark DataFrame operators for cleaning messy delimited
open data into a star schema, checking its quality, and fitting a model on it.

Sub-packages:
  functions  Column -> Column expressions (text, numbers, column names)
  operators  DataFrame -> DataFrame operators (schema, filters, joins, dedup,
             quality, statistics, features)
  sources    delimited scans, sinks, catalog access
  plans      the cleaning plans, dimension builds, views and jobs that
             compose the operators
"""

from terroir.quirks import Quirks

__all__ = ["Quirks"]
