"""tablesync: keep target tables, files and table metadata in step with a
source, and prove that they match, using only Spark DataFrame / SQL /
Structured Streaming APIs.

Every operator is a function from DataFrames to DataFrames; Catalyst and
adaptive query execution choose the physical plan.
"""

__version__ = "0.1.0"
