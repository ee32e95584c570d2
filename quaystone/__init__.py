"""quaystone: service-desk and contract analytics as Spark DataFrame jobs.

Sub-packages:
  functions  Column builders (parsing, dates, money, codes, hashing)
  operators  DataFrame -> DataFrame operators (allocation, revenue, history, ...)
  sources    readers, layout checks and sinks
  plans      bindings of the operators to the driver's tables (queries + oracle SQL)
  streaming  incremental feeds on Structured Streaming
"""

__version__ = "0.1.0"
