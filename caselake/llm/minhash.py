"""Near-duplicate documents by circulant MinHash, confirmed on whole shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.components import components
from caselake.llm.rows import text_of
from caselake.llm.shingles import WordHashes, band_keys, shingle_set, signature
from caselake.session import stage

# Chance that a pair just at the threshold meets in no bucket.
MISS = 1e-6
MOST_BANDS = 40
# Documents in a block; a task compares two blocks.
BLOCK = 512


@dataclass(frozen=True)
class Near:
    """What counts as near: runs of ``words`` words, ``percent`` of them shared."""

    words: int = 5
    percent: int = 80

    def banding(self, most: int) -> tuple[int, int]:
        """Rows and bands: the longest rows for which at most ``most`` bands keep the chance of a miss."""
        t, best = self.percent / 100, None
        for rows in range(1, 17):
            share = t**rows
            bands = 1 if share >= 1 else math.ceil(math.log(MISS) / math.log1p(-share))
            if best is None or bands <= most:
                best = (rows, bands)
        return best

    def linked(self, shared, size_a, size_b):
        return 100 * shared >= self.percent * (size_a + size_b - shared)


def _column(values, kind) -> pa.Array:
    return pa.array(values, type=kind)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def signed(docs: DataFrame, near: Near) -> DataFrame:
    """``doc, version, size, digest, bands``: a document's id, text hash, set size, set digest and bucket keys."""
    rows, bands = near.banding(MOST_BANDS)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column(2):
                members = shingle_set(text.as_py(), near.words, known)
                sizes.append(len(members))
                digests.append(xxhash.xxh3_128_digest(members.tobytes()))
                full = len(members) > 0
                keys.append(band_keys(signature(members, rows * bands), rows) if full else members)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _column(sizes, pa.int64()), _column(digests, pa.binary()), _lists(keys)],
                names=["doc", "version", "size", "digest", "bands"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.xxhash64("text").alias("version"), text_of())
    return texts.mapInArrow(sign, "doc bigint, version bigint, size bigint, digest binary, bands array<bigint>")


def _with_sets(texts: DataFrame, near: Near) -> DataFrame:
    """``node, members`` for ``node, text``."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [shingle_set(text.as_py(), near.words, known) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(sets)], names=["node", "members"])

    return texts.mapInArrow(collect, "node bigint, members array<bigint>")


def _leader_pairs(buckets: DataFrame, leaders: DataFrame, near: Near) -> DataFrame:
    """Each bucket's members with its smallest one, where their sizes allow a link: as many pairs as members."""
    sizes = F.least("size", "leader_size") * 100 >= F.greatest("size", "leader_size") * near.percent
    met = buckets.join(leaders, "bucket").filter((F.col("node") != F.col("leader")) & sizes)
    return met.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("set_b"))
    met = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return met.filter(near.linked(shared, F.size("set_a"), F.size("set_b"))).select("a", "b")


def _open_nodes(buckets: DataFrame, leaders: DataFrame, found: DataFrame) -> DataFrame:
    """``node, component`` of the members of buckets where two members may be linked unseen.

    A bucket is closed if all its members are in one component, or if it has
    no pair besides those with its leader.
    """
    several = buckets.select("bucket", "node").join(leaders.filter("members > 2").select("bucket"), "bucket")
    placed = several.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stage(placed)
    spread = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    still = stage(spread.filter("low <> high").select("bucket"))
    return placed.join(still, "bucket").select("node", "component").distinct()


def _block_links(near: Near):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        """Links of the group's documents that join different components: a spanning forest, not all pairs."""
        group = group.sort_values(["side", "node"], kind="stable")
        nodes, side = group["node"].to_numpy(), group["side"].to_numpy()
        own, places = np.unique(group["component"].to_numpy(), return_inverse=True)
        sizes = group["members"].map(len).to_numpy()
        code = np.unique(np.concatenate(group["members"].to_numpy()), return_inverse=True)[1]
        holder = np.repeat(np.arange(len(nodes)), sizes)
        order = np.argsort(code, kind="stable")
        holders, counts = holder[order], np.bincount(code)
        starts = np.cumsum(counts) - counts
        ends, links = np.cumsum(sizes), []
        same_block = bool((group["left"] == group["right"]).iloc[0])
        for i in range(len(nodes)):
            if not same_block and side[i]:
                break
            codes = code[ends[i] - sizes[i] : ends[i]]
            reps = counts[codes]
            at = np.repeat(starts[codes] - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
            shared = np.bincount(holders[at], minlength=len(nodes))
            may = near.linked(shared, sizes[i], sizes) & (places != places[i])
            may &= (side == 1) if not same_block else (np.arange(len(nodes)) > i)
            while may.any():
                j = int(np.argmax(may))
                links.append((nodes[i], nodes[j]))
                places[places == places[j]] = places[i]
                may &= places != places[i]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return compare


def _unseen_links(open_nodes: DataFrame, sets: DataFrame, near: Near) -> DataFrame:
    """Links between components that no leader showed, compared block by block inside tasks.

    Documents meet again in fresh, wider buckets. A bucket of more than
    ``BLOCK`` documents is cut into blocks and every two blocks are compared
    by one task, so no task holds more than two blocks, whatever the bucket.
    """
    rows = 2
    bands = math.ceil(math.log(MISS) / math.log1p(-((near.percent / 100) ** rows))) if near.percent < 100 else 1

    def rekey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for members in batch.column(2):
                whole = np.asarray(members.values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
                keys.append(band_keys(signature(whole, rows * bands), rows))
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(keys)], names=[*batch.schema.names, "keys"])

    kind = "node bigint, component bigint, members array<bigint>, keys array<bigint>"
    keyed = open_nodes.join(sets, "node").select("node", "component", "members").mapInArrow(rekey, kind)
    keyed = stage(keyed)
    slim = keyed.select("node", "component", F.explode("keys").alias("bucket"))
    sized = slim.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    sized = stage(sized.filter("low <> high").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    placed = slim.join(sized, "bucket")
    block = F.pmod(F.xxhash64("node", "bucket"), "blocks").cast("int")
    every = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(
            F.least(other, F.col("block")).alias("left"),
            F.greatest(other, F.col("block")).alias("right"),
            (F.col("block") > other).cast("int").alias("side"),
        ),
    )
    dealt = placed.withColumn("block", block).select("node", "component", "bucket", F.inline(every))
    full = dealt.join(keyed.select("node", "members"), "node")
    return full.groupBy("bucket", "left", "right").applyInPandas(_block_links(near), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """``doc_id, version, n_shingles, component_id, kept``: one row per row of ``docs`` (``doc_id, text``).

    Two documents are linked if their sets of word runs share ``percent`` of
    their union. ``component_id`` is the smallest id reachable by links, and
    ``kept`` marks it. ``version`` is the hash of the text.

    Documents of one set are one node. Signatures are cut into bands so that a
    pair at the threshold is missed with a chance of ``MISS`` at most. Every
    bucket compares its members with its smallest one only, on whole sets; the
    few buckets that then still hold several components are compared in full,
    in blocks and inside tasks, so that no link between components is lost and
    no group is expanded into all its pairs.

    A text without words has an empty set and is linked with nothing. Rows of
    one id are one document, linked as any of its texts is. Rows without an id
    are linked with nothing and kept. An empty table gives an empty table.
    """
    every = stage(signed(docs, near))
    usable = every.filter("size > 0 AND doc IS NOT NULL")
    first = F.row_number().over(Window.partitionBy("digest").orderBy("doc"))
    classes = stage(
        usable.withColumn("nth", first).filter("nth = 1").select(F.col("doc").alias("node"), "digest", "size", "bands")
    )
    buckets = classes.select("node", "size", F.explode("bands").alias("bucket"))
    smallest = F.min(F.struct("node", "size"))
    leaders = buckets.groupBy("bucket").agg(smallest.alias("low"), F.count(F.lit(1)).alias("members"))
    leaders = stage(
        leaders.filter("members > 1").select(
            "bucket", F.col("low.node").alias("leader"), F.col("low.size").alias("leader_size"), "members"
        )
    )
    pairs = stage(_leader_pairs(buckets, leaders, near))
    candidates = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    trios = buckets.join(leaders.filter("members > 2").select("bucket"), "bucket").select("node")
    candidates = stage(candidates.union(trios).distinct())
    texts = docs.select(F.col("doc_id").cast("bigint").alias("node"), text_of().alias("text"))
    sets = stage(_with_sets(texts.join(candidates, "node", "left_semi"), near))
    links = stage(_confirmed(pairs, sets, near))
    found = stage(components(links))
    more = stage(_unseen_links(stage(_open_nodes(buckets, leaders, found)), sets, near))
    if not more.isEmpty():
        found = stage(components(links.union(more)))
    homes = classes.select("node", "digest").join(found, "node", "left")
    homes = stage(homes.select("digest", F.coalesce("component", "node").alias("component")))
    out = every.join(homes, "digest", "left")
    component = F.when(F.col("size") > 0, F.col("component"))
    component = F.when(F.col("doc").isNotNull(), F.coalesce(component, F.col("doc")))
    return out.select(
        F.col("doc").alias("doc_id"),
        "version",
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"),
    )
