"""quillspark: table-in / table-out analytics on Spark DataFrames.

Subpackages:
  sources    readers for the stored tables, text, CSV/TSV, and the sinks
  functions  column expressions (text, access-log fields, addresses, numeric)
  operators  multi-step DataFrame jobs (word counts, logs, geo, features, grids, images)
  plans      the query catalog registered in ``__spark_entry__`` and its SQL oracles
  streaming  incremental (file-stream) variants of the log reports
"""

__version__ = "0.1.0"
