"""Catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    table = spark.table(name)
    return table.select(*columns) if columns else table
