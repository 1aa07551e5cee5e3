"""Spark operators for fraud and risk analysis of claims.

Every public function takes DataFrames (or Columns) and returns DataFrames
(or Columns); column names are parameters and no path is fixed.
"""
