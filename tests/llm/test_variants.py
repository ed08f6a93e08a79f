from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest

from caselake.llm import variants
from caselake.llm.queries import op11_spelling_variants
from caselake.llm.variants import near_pairs, spelling_variants


def counted(rows, shortest=5, fewest=3) -> Counter:
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return Counter({w: n for w, n in total.items() if len(w) >= shortest and n >= fewest})


def deletions(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def expected(total: Counter, factor=2) -> set:
    """Near words over shared deletions, each confirmed by its definition."""
    by_key: dict[str, set] = {}
    for word in total:
        for key in deletions(word) | {word}:
            by_key.setdefault(key, set()).add(word)

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return abs(len(a) - len(b)) == 1 and min(a, b, key=len) in deletions(max(a, b, key=len))

    rows, forms, found = set(), {}, {}
    for word, n in total.items():
        others = {o for key in deletions(word) | {word} for o in by_key[key] if near(word, o)}
        best = min(others, key=lambda o: (-total[o], o), default=None)
        forms[word] = best if best is not None and total[best] >= factor * n else None
        found[word] = len(others)
    for word, n in total.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        form = forms[word]
        rows.add((word, form, root, n, found[word], None if form is None else total[form]))
    return rows


def as_rows(df) -> list:
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


def test_query_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    mine = as_rows(op11_spelling_variants(spark, sf_dir))
    assert len(mine) == len(set(mine))
    assert set(mine) == expected(counted(rows))
    assert any(form is not None and form != root for _, form, root, *_ in mine)


@pytest.mark.parametrize("chunk", [4096, 3])
def test_all_pairs_of_few_letters(spark, monkeypatch, chunk):
    """Words of two letters, so that extra letters can be told in several ways; blocks also in chunks."""
    monkeypatch.setattr(variants, "CHUNK", chunk)
    words = sorted({f"{i:b}".translate({48: "a", 49: "b"}) for i in range(1, 140)} | {"é" * k for k in (1, 2, 3, 5)})
    table = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n bigint")
    mine = sorted((r.word, r.near, r.near_n) for r in near_pairs(table).collect())
    total = {w: i + 1 for i, w in enumerate(words)}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return abs(len(a) - len(b)) == 1 and min(a, b, key=len) in deletions(max(a, b, key=len))

    assert mine == sorted((a, b, total[b]) for a in words for b in words if near(a, b))


def test_edge_cases(spark, docs, no_docs, clashing):
    assert set(as_rows(spelling_variants(docs))) == expected(counted([tuple(r) for r in docs.collect()]))
    assert set(as_rows(spelling_variants(clashing))) == set(as_rows(spelling_variants(docs)))
    empty = spelling_variants(no_docs)
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and not empty.collect()


def test_chain_ties_and_long_words(spark):
    """A chain of four, two equally frequent near words, and words of many letters."""
    chain = ["grammar", "grammer", "gremmer", "kremmer"]
    text = " ".join(w for i, w in enumerate(reversed(chain)) for _ in range(3 * 2 ** (2 * i)))
    text += " house" * 3 + " mouse" * 8 + " rouse" * 8 + (" " + "x" * 30_000) * 9 + (" " + "x" * 30_001) * 3
    rows = [(1, text), (1, text)]
    mine = as_rows(spelling_variants(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert set(mine) == expected(counted(rows)) and len(mine) == len(set(mine))
    roots = {word: (form, root) for word, form, root, *_ in mine}
    assert roots["kremmer"] == ("gremmer", "grammar")
    assert roots["house"] == ("mouse", "mouse")
