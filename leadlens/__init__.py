"""leadlens: lead- and customer-funnel analytics as Spark DataFrame operators.

Sub-packages:
  functions  column expressions (names, phones, dates, text scrubbing)
  operators  DataFrame -> DataFrame building blocks (match join, per-key
             selection, survivor dedup, profiles, type inference)
  sources    table loading, JSON report feeds, column-name sanitising
  sinks      table / delimited / report writers
  plans      composite funnel plans and the queries over the driver tables
"""

__version__ = "0.1.0"
