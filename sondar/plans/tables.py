"""Loading the tables of a directory, one parquet each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def buckets_for(rows: int, per_bucket: int, least: int = 1) -> int:
    """The number of hash buckets, a power of two, that holds rows at about per_bucket each."""
    need = max(least, -(-max(rows, 1) // per_bucket))
    return 1 << (need - 1).bit_length()
