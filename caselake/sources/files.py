"""CSV files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caselake.operators.inference import ColumnProfile, profile_measures, profiles
from caselake.session import staged


def read_csv(spark: SparkSession, uri: str, schema: str | StructType = "infer") -> DataFrame:
    """Headed CSV files under any URI Spark can open.

    ``schema="infer"`` costs a pass over the data; ``"string"`` keeps every
    field as text (batches appended to one table then always agree on types);
    a StructType (or DDL text) declares it.
    """
    reader = spark.read.option("header", True)
    if schema == "infer":
        return reader.csv(uri, inferSchema=True)
    if schema == "string":
        return reader.csv(uri)
    return reader.schema(schema).csv(uri)


@contextmanager
def profiled(text: DataFrame, source_column: str) -> Iterator[tuple[DataFrame, list[ColumnProfile]]]:
    """The rows of a scan of text columns as stored, with each one's file in ``source_column``, and the column profiles.

    The files are read once: the profiles are observed while the text is
    written to the shared folder, which loses it after the block. So types and
    rows agree even if files are added meanwhile. Only the profiles, a few
    figures a column, reach the driver.
    """
    seen = Observation()
    observed = text.observe(seen, *profile_measures(text.columns))
    with staged(observed.select("*", F.col("_metadata.file_path").alias(source_column))) as stored:
        yield stored, profiles(text.sparkSession, text.columns, seen.get)
