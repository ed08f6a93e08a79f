from __future__ import annotations

import random

import pytest

from caselake.llm.components import components
from caselake.llm.minhash import BLOCK, Near, near_duplicates
from caselake.llm.shingles import WordHashes, shingle_set, signature


def shingles(text, words):
    found = (text or "").encode().lower().split()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))) if found else frozenset()


def by_brute_force(rows, near):
    """Component per row for rows of (id, text): the smallest id that links reach."""
    sets = [shingles(text, near.words) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            linked = a and b and near.linked(len(a & b), len(a), len(b))
            same_id = rows[i][0] == rows[j][0]
            if rows[i][0] is not None and rows[j][0] is not None and (linked or same_id):
                x, y = find(i), find(j)
                parent[x] = y
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[find(i)] = min(doc, smallest.get(find(i), doc))
    return [smallest.get(find(i)) if doc is not None else None for i, (doc, _) in enumerate(rows)]


def family(seed, size, edits, words=60):
    """Texts that share a base and differ in a few words each."""
    rng = random.Random(seed)
    base = [f"w{seed}x{i}" for i in range(words)]
    texts = [" ".join(base)]
    for _ in range(size):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"e{rng.random()}"
        texts.append(" ".join(text))
    return texts


def check(spark, rows, near):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = near_duplicates(df, near).collect()
    expected = by_brute_force(rows, near)
    got = sorted(map(repr, ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found)))
    want = [(d, len(shingles(t, near.words)), c, d == c) for (d, t), c in zip(rows, expected)]
    assert got == sorted(map(repr, want))


@pytest.mark.parametrize("near", [Near(), Near(words=3, percent=85)])
def test_families_against_brute_force(spark, near):
    texts = [t for seed, edits in ((1, 1), (2, 4), (3, 9), (4, 2)) for t in family(seed, 45, edits)]
    texts += ["a b", "A  B", "a b c", "b c a", "x"]
    random.Random(1).shuffle(texts)
    check(spark, [(3 * i + 1, t) for i, t in enumerate(texts)], near)


def test_edge_rows(spark, docs, clashing, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(spark, rows, Near(words=2, percent=80))
    assert near_duplicates(no_docs).count() == 0
    assert near_duplicates(clashing).count() == len(rows)


def test_a_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr("caselake.llm.minhash.BLOCK", 16)
    texts = family(9, 150, 12)
    check(spark, list(enumerate(texts)), Near(words=3, percent=85))
    assert BLOCK > 16


def test_banding_keeps_the_chance_of_a_miss(spark):
    for near in (Near(), Near(3, 85), Near(3, 95), Near(3, 50), Near(3, 100)):
        rows, bands = near.banding(40)
        assert (1 - (near.percent / 100) ** rows) ** bands <= 1.1e-6


def test_signatures_estimate_similarity():
    known = WordHashes()
    a = shingle_set(" ".join(f"a{i}" for i in range(1000)), 1, known)
    b = shingle_set(" ".join(f"a{i}" for i in range(300, 1300)), 1, known)
    same = (signature(a, 512) == signature(b, 512)).mean()
    assert abs(same - 700 / 1300) < 0.08


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i + 1, i) for i in range(100, 400)]
    star = [(1000, i) for i in range(1001, 1300)]
    rows = [*chain, *star, (5000, 5001), (5001, 5002), (5002, 5000), (7, 7), (None, 3)]
    df = spark.createDataFrame(rows, "x bigint, y bigint").repartition(5)
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {**{i: 100 for i in range(100, 401)}, **{i: 1000 for i in range(1000, 1300)}, 5000: 5000, 5001: 5000, 5002: 5000}
    assert components(df.limit(0)).count() == 0
