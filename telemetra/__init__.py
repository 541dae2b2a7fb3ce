"""telemetra — sensor time-series data flows expressed as Spark DataFrame plans.

Sub-packages:
  functions  scalar Column builders (parsing, shifting, formatting)
  operators  DataFrame -> DataFrame transforms (rules, reshape, dedup, hierarchy …)
  sources    readers and writers (typed JSON, CSV, parquet tables, ledgers)
  streaming  file-source Structured Streaming imports
  plans      end-to-end flows and the driver-table query catalog
"""

__version__ = "0.1.0"
