from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselake.llm import spherical
from caselake.llm.spherical import near_vectors

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def by_brute_force(rows, threshold):
    def unit(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, float)
        a /= np.abs(a).max()
        return a / np.linalg.norm(a)

    units = [unit(v) if label is not None and i is not None else None for i, v, label in rows]
    home, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for i, a in enumerate(units):
        for j, b in enumerate(units[:i]):
            if a is None or b is None or len(a) != len(b) or rows[i][2] != rows[j][2] or a @ b < threshold:
                continue
            links[i] += 1
            links[j] += 1
            x, y = find(i), find(j)
            home[x] = y
    low = {}
    for i, (v, _, _) in enumerate(rows):
        low[find(i)] = v if v is None else min(v, low.get(find(i), v))
    return [(v, n, low[find(i)], v == low[find(i)]) for i, ((v, _, _), n) in enumerate(zip(rows, links))]


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = near_vectors(df).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, by_brute_force(rows, 0.98)))


def made(n, width=16, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, width))
    rows = []
    for i in range(n):
        spread = rng.choice([0.02, 0.05, 0.08, 3.0])
        rows.append((i, (base[rng.integers(12)] + spread * rng.normal(size=width)).tolist(), int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("cell, block", [(1024, 1024), (40, 32)])
def test_against_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(spherical, "CELL", cell)
    monkeypatch.setattr(spherical, "BLOCK", block)
    rows = made(500)
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(60)]
    check(spark, rows)


def test_edge_rows(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(1, one, 1), (1, one, 1), (2, one, 1), (3, [2.0, 0.0, 0.0], 1), (4, [1e200, 1.0, 1.0], 1), (5, one, 2)]
    rows += [(6, one, None), (7, None, 1), (8, [0.0] * 3, 1), (9, [1.0, None, 0.0], 1), (10, [float("nan"), 0.0, 0.0], 1)]
    rows += [(11, [float("inf"), 0.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, [], 1), (None, one, 1), (14, [1e-300, 0.0, 0.0], 1)]
    check(spark, rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert near_vectors(df.limit(0)).count() == 0
    wide = df.withColumns({n: F.lit(0) for n in ("key", "node", "n", "cell", "guest", "vector", "n_links", "component_id", "kept")})
    assert near_vectors(wide).count() == len(rows)


def test_single_precision_of_the_table(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    found = near_vectors(vectors).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, by_brute_force(rows, 0.98)))
