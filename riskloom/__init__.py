"""Spark-first commercial risk analytics.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns). Nothing is executed until a caller asks for rows, except where a
docstring says that a table is written or a model is fitted.
"""
