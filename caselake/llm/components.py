"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.session import stage


def _centre(pairs: DataFrame) -> DataFrame:
    """Pairs ``a, b`` with the smallest of each ``a`` and its ``b`` as ``low``.

    The minima are written first: a node with very many links can then be
    split over several tasks when they are joined back.
    """
    low = pairs.groupBy("a").agg(F.min("b").alias("low"))
    low = stage(low.select("a", F.least("a", "low").alias("low")))
    return pairs.join(low, "a")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b"), F.col("a")))
    return _centre(both).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    met = _centre(down)
    return met.select(F.col("b").alias("a"), F.col("low").alias("b")).union(met.select("a", F.col("low").alias("b")))


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (two columns of one orderable type).

    The component is its smallest node. Each round moves every node next to a
    smaller one and halves what is left of long chains; rounds end when the
    links are a set of stars. Only a count and a checksum reach the driver.
    Pairs with a null, and pairs of a node with itself, link nothing.
    """
    left, right = links.columns
    now = links.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a <> b")
    now = stage(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, digest = None, _digest(now)
    while digest != before:
        for star in (_large_star, _small_star):
            now = stage(star(now).filter("a <> b").distinct())
        before, digest = digest, _digest(now)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(now.select("b", "b").distinct())
