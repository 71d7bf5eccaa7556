"""Civic-records analytics on Spark DataFrames.

The package turns irregular nested JSON into typed fact and satellite tables, keeps them in
partitioned parquet with lineage, and answers parameterised analytic queries over them.
Everything is a DataFrame plan; VARIANT carries the irregular values.
"""
