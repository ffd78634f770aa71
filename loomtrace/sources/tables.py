"""Parquet tables of one directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``sf_dir``, which any store that Spark reads may hold."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
