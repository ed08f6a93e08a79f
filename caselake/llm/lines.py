"""Dropping lines that many documents share. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.rows import SPACES, lower_ascii, text_of, unpacked, with_row
from caselake.session import stage


def line_key(line: Column) -> Column:
    """What two lines have in common to count as one: no outer white space, no ASCII case."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def drop_shared_lines(
    docs: DataFrame,
    min_chars: int = 40,
    min_docs: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    r"""``docs`` with shared lines dropped from the text, and ``n_lines`` and ``n_dropped`` added.

    A text is split at ``\n``. A line whose key has at least ``min_chars``
    code points and occurs in at least ``min_docs`` documents is dropped from
    every document but the one of the largest id that holds it (where all its
    repeats stay). ``n_lines`` counts the lines before dropping.

    Lines are exploded to a 128-bit hash of their key, which is all that the
    counting shuffles move. Documents are counted in two steps, by key and
    document and then by key, so a line that a third of the documents hold
    spreads over all tasks; the join back splits such a key at run time. The
    texts move once, to meet the positions that they lose.

    Null or empty text is one empty line. Rows of one id count as one document
    and all rows without an id as one that is smaller than any other; each row
    keeps its own text. An empty table gives an empty table. Columns named
    ``n_lines`` and ``n_dropped`` are replaced, all others are passed on.
    """
    doc, text = F.col(f"`{id_column}`"), text_of(text_column)
    exploded = docs.select(
        doc.alias("doc"), F.xxhash64(text).alias("version"), F.posexplode(F.split(text, "\n", -1)).alias("at", "line")
    )
    keyed = exploded.withColumn("line", line_key(F.col("line"))).filter(F.char_length("line") >= min_chars)
    hashed = keyed.withColumn("key", F.unhex(F.md5("line"))).select("key", "doc", "version", "at")

    holders = hashed.select("key", "doc").distinct()
    shared = holders.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("keeper"))
    shared = stage(shared.filter(F.col("docs") >= min_docs).select("key", "keeper"))

    lost = (
        hashed.join(shared, "key")
        .filter(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy("doc", "version")
        .agg(F.collect_set("at").alias("lost"))
    )
    rows = with_row(docs, of=doc, text=text).alias("r")
    same = F.col("r.of").eqNullSafe(F.col("l.doc")) & (F.xxhash64("r.text") == F.col("l.version"))
    met = rows.join(lost.alias("l"), same, "left").withColumn("lines", F.split("text", "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))
    rest = F.array_join(F.transform(left, lambda i: F.get(F.col("lines"), i)), "\n")
    return unpacked(
        met,
        **{text_column: F.when(F.col("lost").isNull(), F.col("text")).otherwise(rest)},
        n_lines=F.size("lines").cast("bigint"),
        n_dropped=F.coalesce(F.size("lost"), F.lit(0)).cast("bigint"),
    )
