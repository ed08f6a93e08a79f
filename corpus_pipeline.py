"""A corpus from raw documents: each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.langid import fit, identify
from caselake.llm.lines import drop_shared_lines
from caselake.llm.minhash import Near, near_duplicates
from caselake.llm.packing import pack
from caselake.llm.queries import vocabulary
from caselake.session import stage


def _numbered(docs: DataFrame, *kept: str) -> DataFrame:
    """``docs`` with all columns but ``kept`` named by number, so that none can clash with what an operator adds."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in kept else f"__{i}") for i, c in enumerate(docs.columns)])


def _named(rows: DataFrame, docs: DataFrame, *kept: str) -> DataFrame:
    """The columns of ``docs`` under their own names again."""
    return rows.select(*[F.col(c if c in kept else f"__{i}").alias(c) for i, c in enumerate(docs.columns)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go, null and empty texts and those without letters among them.

    The model learns from rows with text and a language; without any, nothing is recognised.
    All columns are passed on as they are, whatever their names; texts are read whole.
    """
    model = fit(docs.select("doc_id", "text", "lang"))
    return _named(identify(_numbered(docs, "text"), model).filter("NOT rejected"), docs, "text")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; ``n_chars`` follows the text.

    A null text becomes the empty text and all rows stay. The other columns
    are passed on as they are, whatever their names.
    """
    ids = ("doc_id", "text")
    kept = _named(drop_shared_lines(_numbered(docs, *ids)), docs, *ids)
    return kept.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id stays; of rows of one id and text, one.

    Null texts, texts without words and rows without an id are near nothing
    and stay. All columns are passed on as they are, whatever their names.
    """
    found = near_duplicates(docs.select("doc_id", "text"), Near(words=5, percent=80)).filter("kept")
    named = found.groupBy(F.col("doc_id").alias("kept_id"), "version").agg(F.count(F.lit(1)).alias("rows"))
    named = stage(named)
    rows = _numbered(docs, "doc_id", "text")
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("text") == F.col("version"))
    kept = rows.join(named, same, "left_semi")
    # Rows are compared once more only where some repeat.
    kept = kept if named.filter("rows > 1").isEmpty() else kept.dropDuplicates(["doc_id", "text"])
    return _named(kept, docs, "doc_id", "text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of at most 4096 ids.

    A null or empty text is its end id alone; columns other than the id and the text are left out.
    """
    return pack(docs.select("doc_id", "text"), vocabulary("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("packing", packing),
]

# Language identification is a trained model, so SQL cannot state the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
