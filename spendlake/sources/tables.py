"""Parquet tables: the driver's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
