"""Registered queries: name -> callable(spark, sf_dir); and their DuckDB equivalents."""
