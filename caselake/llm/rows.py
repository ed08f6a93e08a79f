"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def with_row(df: DataFrame, **more: Column) -> DataFrame:
    """The whole row as struct ``row`` beside the columns ``more``, so that no input name can clash."""
    return df.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in more.items()])


def unpacked(df: DataFrame, **more: Column) -> DataFrame:
    """The columns of ``row``, of which ``more`` replaces those of the same name and follows with the others.

    Two steps, as an alias of the same select could stand in for a column.
    """
    names = df.schema["row"].dataType.names
    made = df.select("row", *[c.alias(f"__{name}") for name, c in more.items()])
    held = [F.col(f"__{c}").alias(c) if c in more else F.col("row").getField(c).alias(c) for c in names]
    return made.select(*held, *[F.col(f"__{c}").alias(c) for c in more if c not in names])


def text_of(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and no other letter; text of ASCII alone goes the short way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def utf8_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
