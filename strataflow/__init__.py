"""Medallion analytics on Spark: raw files to a star schema, all as DataFrames."""
