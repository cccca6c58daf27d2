"""situate: context-aware content strategy analytics on Spark.

Every public function maps DataFrames to DataFrames (or Columns to Columns);
the heavy lifting is declared with the DataFrame API and left to Catalyst.
"""

__all__ = ["session"]
