"""Near-duplicate vectors by spherical k-means cells and blocked cosine products."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.components import components
from caselake.session import stage

# Vectors of one label that a cell should hold, and in each block of a cell.
CELL, BLOCK = 1024, 1024
# Bounds of what is fitted on the driver: cells, vectors drawn for each, rounds.
MOST_CELLS, DRAWN_PER_CELL, ROUNDS = 1024, 64, 12


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, no null or non-finite component, not zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def spherical_means(vectors: np.ndarray, cells: int) -> np.ndarray:
    """Unit centres of ``cells`` groups of unit vectors; an empty group takes the worst-fitting vector."""
    rng = np.random.default_rng(11)
    centres = vectors[rng.choice(len(vectors), min(cells, len(vectors)), replace=False)]
    for _ in range(ROUNDS):
        scores = vectors @ centres.T
        home = scores.argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, vectors)
        sizes = np.linalg.norm(sums, axis=1)
        worst = iter(np.argsort(scores.max(1)))
        for empty in np.flatnonzero(sizes < 1e-9):
            sums[empty] = vectors[next(worst)]
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centres


def _unit(flat: np.ndarray, width: int) -> np.ndarray:
    vectors = flat.reshape(-1, width).astype(float)
    # Scaled first: squares of very large or small components would leave the range of a double.
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _fit(classes: DataFrame, groups: DataFrame) -> np.ndarray | None:
    """Centres for the label and width with most vectors, from a bounded draw by hash; None if one cell will do."""
    largest = groups.orderBy(F.desc("n"), "width").first()
    if largest is None or largest["n"] <= CELL:
        return None
    cells = min(MOST_CELLS, -(-largest["n"] // CELL))
    drawn = classes.filter(F.size("vector") == largest["width"])
    drawn = drawn.orderBy(F.xxhash64("node"), "node").limit(cells * DRAWN_PER_CELL).select("vector").toPandas()
    return spherical_means(_unit(np.concatenate(drawn["vector"].to_numpy()), largest["width"]), cells)


def _in_cells(classes: DataFrame, centres: np.ndarray | None, threshold: float) -> DataFrame:
    """``classes`` with ``cell`` and ``guest``: each vector in its home cell and, as a guest, in others.

    Two vectors of a cosine of at least ``threshold`` are at most ``reach``
    apart. If their homes differ, both are at most so far from the plane
    between the two cells. So the one of the later home visits every earlier
    cell whose plane is that near, and no pair is missed.
    """
    if centres is None:
        return classes.withColumns({"cell": F.lit(0), "guest": F.lit(False)})
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    # One product of the unit centres: its size is that of their number alone, whatever their width.
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (centres @ centres.T)))
    np.fill_diagonal(apart, 1.0)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            widths = np.diff(vectors.offsets.to_numpy())
            big = batch.column("big").to_numpy(zero_copy_only=False) & (widths == centres.shape[1])
            rows, cells = [np.flatnonzero(~big)], [np.zeros((~big).sum(), np.int64)]
            guests = [np.zeros((~big).sum(), bool)]
            if big.any():
                own = np.flatnonzero(big)
                flat = vectors.take(pa.array(own)).flatten().to_numpy()
                scores = _unit(flat, centres.shape[1]) @ centres.T
                home = scores.argmax(1)
                distance = (scores[np.arange(len(own)), home][:, None] - scores) / apart[home]
                near = (distance <= reach) & (np.arange(len(centres)) <= home[:, None])
                row, cell = np.nonzero(near)
                rows.append(own[row])
                cells.append(cell)
                guests.append(cell != home[row])
            row = np.concatenate(rows)
            kept = batch.select(["label", "vector", "node", "n"]).take(pa.array(row))
            columns = [*kept.columns, pa.array(np.concatenate(cells).astype(np.int32)), pa.array(np.concatenate(guests))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept.schema.names, "cell", "guest"])

    kind = {f.name: f.dataType.simpleString() for f in classes.schema}
    schema = f"label {kind['label']}, vector {kind['vector']}, node bigint, n bigint, cell int, guest boolean"
    return classes.mapInArrow(place, schema)


def _dealt(placed: DataFrame) -> DataFrame:
    """A copy of each vector for every pair of blocks in which it is compared; ``side`` 1 is compared with ``side`` 0."""
    key = ["label", "width", "cell"]
    placed = placed.withColumn("width", F.size("vector"))
    counted = placed.groupBy(*key).agg(
        F.ceil(F.count_if(~F.col("guest")) / BLOCK).cast("int").alias("homes"),
        F.ceil(F.count_if(F.col("guest")) / BLOCK).cast("int").alias("guests"),
    )
    joined = placed.join(stage(counted.filter("homes > 0")), key)
    block = F.pmod(F.xxhash64("node", "cell"), F.when(F.col("guest"), F.col("guests")).otherwise(F.col("homes")))
    joined = joined.withColumn("block", block.cast("int"))

    def pair(left: Column, right: Column, side: Column) -> Column:
        return F.struct(left.alias("left"), right.alias("right"), side.cast("int").alias("side"))

    def upto(n: str) -> Column:
        return F.filter(F.sequence(F.lit(0), F.greatest(F.col(n), F.lit(1)) - 1), lambda i: i < F.col(n))

    own = F.col("block")
    among_homes = F.transform(upto("homes"), lambda j: pair(F.least(own, j), F.greatest(own, j), own > j))
    # Guest blocks are numbered below zero, so that they never meet a home's number.
    with_guests = F.transform(upto("guests"), lambda j: pair(own, -1 - j, F.lit(0)))
    as_guest = F.transform(upto("homes"), lambda i: pair(i, -1 - own, F.lit(1)))
    copies = F.when(F.col("guest"), as_guest).otherwise(F.concat(among_homes, with_guests))
    return joined.select(*key, "node", "n", "vector", F.inline(copies))


def _compare(threshold: float):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        """Each vector's links in this pair of blocks, and links that join what is not joined yet."""
        vectors = _unit(np.concatenate(group["vector"].to_numpy()), int(group["width"].iloc[0]))
        node, n, side = group["node"].to_numpy(), group["n"].to_numpy(), group["side"].to_numpy()
        same = group["left"].iloc[0] == group["right"].iloc[0]
        a = np.arange(len(node)) if same else np.flatnonzero(side == 0)
        b = a if same else np.flatnonzero(side == 1)
        near = vectors[a] @ vectors[b].T >= threshold
        if same:
            np.fill_diagonal(near, False)
        links = np.zeros(len(node), np.int64)
        links[a] += near @ n[b]
        if not same:
            links[b] += n[a] @ near
        home, found = np.arange(len(node)), []
        for i, row in zip(a, near):
            hit = b[row]
            hit = hit[home[hit] != home[i]]
            _, first = np.unique(home[hit], return_index=True)
            for j in hit[first]:
                found.append((node[i], node[j], 0))
            if len(first):
                home[np.isin(home, home[hit])] = home[i]
        counted = [(x, None, k) for x, k in zip(node[links > 0], links[links > 0])]
        out = pd.DataFrame(found + counted, columns=["a", "b", "links"])
        return out.astype({"a": "int64", "b": "Int64", "links": "int64"})

    return compare


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``vectors`` (``vec_id, embedding, label``).

    Vectors of one label are linked at a cosine of at least ``threshold``, in
    double precision. Equal vectors are one node that counts as many links as
    it has rows. Spherical k-means, fitted on at most ``MOST_CELLS *
    DRAWN_PER_CELL`` vectors drawn by hash, gives cells; vectors near the border
    of a cell are compared there too, so that all pairs are found. Cells are
    compared in blocks: a task holds two blocks, whatever the cell, and returns
    link counts and a spanning forest instead of pairs.

    Null label, null or zero vectors, and vectors with null or non-finite
    components are linked with nothing, and so are rows without an id.
    Repeated rows are vectors of their own. Vectors of different width are not
    compared. An empty table gives an empty table.
    """
    vector, label, vec_id = F.col("embedding"), F.col("label"), F.col("vec_id").cast("bigint")
    able = usable(vector) & label.isNotNull() & vec_id.isNotNull()
    key = F.struct(F.xxhash64(vector), F.xxhash64(F.lit(1), vector), label)
    rows = vectors.select(vec_id.alias("vec_id"), F.when(able, key).alias("key"), label.alias("label"), vector.alias("vector"))
    smallest = F.min_by(F.struct("label", "vector"), "vec_id").alias("of")
    classes = rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n"), smallest
    )
    classes = stage(classes.select("key", "node", "n", "of.label", "of.vector"))
    groups = classes.groupBy("label", F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    groups = stage(groups)
    centres = _fit(classes, groups)
    big = groups.filter(F.col("n") > CELL).groupBy("label").agg(F.lit(True).alias("big"))
    sized = classes.join(stage(big), "label", "left").withColumn("big", F.coalesce("big", F.lit(False)))
    dealt = _dealt(stage(_in_cells(sized.select("label", "vector", "node", "n", "big"), centres, threshold)))
    found = dealt.groupBy("label", "width", "cell", "left", "right").applyInPandas(
        _compare(threshold), "a bigint, b bigint, links bigint"
    )
    found = stage(found)
    homes = components(found.filter("b IS NOT NULL").select("a", "b"))
    counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    known = classes.select("key", "node", "n").join(homes, "node", "left")
    known = known.join(counts.withColumnRenamed("a", "node"), "node", "left")
    known = stage(
        known.select(
            "key",
            F.coalesce("component", "node").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        )
    )
    out = rows.select("vec_id", "key").join(known, "key", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
