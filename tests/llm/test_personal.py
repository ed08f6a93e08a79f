from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from caselake.llm import personal
from caselake.llm.personal import KINDS, personal_data
from caselake.llm.queries import op12_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, hit):
    digits = [int(c) for c in hit if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base(text):
    spans = []
    for n, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text or ""):
            if holds(kind, m.group()):
                spans.append((m.start(), n, m.end()))
    return [f"{KINDS[n]}:{start}:{end}" for start, n, end in sorted(spans)]


def expected(text):
    spans = base(text)
    return tuple(sum(s.startswith(k) for s in spans) for k in KINDS) + (spans,)


def check(df, texts):
    """Base spans as by the plain patterns, and all of them among the spans, which overlap no base span."""
    rows = df.collect()
    assert len(rows) == len(texts)
    key = lambda row: repr(row)
    mine = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, list(r.base_spans)) for r in rows), key=key)
    assert mine == sorted(((i, *expected(t)) for i, t in texts), key=key)
    for r in rows:
        assert set(r.base_spans) <= set(r.spans)
        at = lambda s: tuple(map(int, s.split(":")[1:]))
        order = [(at(s)[0], KINDS.index(s.split(":")[0])) for s in r.spans]
        assert order == sorted(order)
        for added in set(r.spans) - set(r.base_spans):
            start, end = at(added)
            assert all(e <= start or s >= end for s, e in map(at, r.base_spans))


def test_query_against_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op12_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        *counts, spans = expected(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts)
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r.spans.split(",")) | {""}


ODD = [
    "a@b.c_d@e.f, x@y, a@b@c.d .@-.- 1.2.3.4.5.6.7.8 256.1.1.1 0000001.2.3.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 378282246310005; 1 2 3 4 5 6 7 8 9 0 1 2",
    "+1 (743) 555-3824 +49 30 123456 ++1 2 +1234567 +12.34.56.78.90 +1-2-3-4-5-6-7-8-9-",
    "é𝔘 näme@exämple.com ☃bob@mail.example.org 𝔘+1 (999) 555-1234x",
    "1" * 6_000 + " " + "a" * 6_000 + "@" + "b." * 20_000 + "+1" + "(" * 5_000,
    "9 " * 20_000 + "1.1." * 5_000,
    "@",
]


def test_edge_cases(spark, docs, no_docs, clashing):
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    every = docs.union(more)
    check(personal_data(every), [tuple(r) for r in every.collect()])
    assert sorted(map(repr, personal_data(clashing).collect())) == sorted(map(repr, personal_data(docs).collect()))
    empty = personal_data(no_docs)
    assert empty.columns == ["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"] and not empty.collect()


@pytest.fixture(scope="module")
def mixed(spark):
    """Numbers to call in three forms, disguised addresses, and numbers that are neither."""
    rows = []
    for i in range(300):
        rows.append(f"please call +1 (555) {100 + i}-{2000 + i} today, or mail user{i}@mail{i % 7}.example.com now")
        rows.append(f"my phone is (555) {100 + i}-{3000 + i} at night")
        rows.append(f"version {1000000 + 37 * i} of the text, key={20000000 + 91 * i}x and isbn {30000000 + 17 * i}")
    rows += ["write to jane.roe (at) example (dot) com", "nothing here at all"]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")


def test_added_spans(mixed):
    found = {r.doc_id: r for r in personal_data(mixed).collect()}
    assert all(found[i].n_phone == found[i].n_email == 1 for i in range(0, 900, 3))
    # The unprefixed numbers have no base span and are added; numbers of versions and keys are not.
    assert all(not found[i].base_spans and len(found[i].spans) == 1 for i in range(1, 900, 3))
    assert all(not found[i].spans for i in range(2, 900, 3))
    assert found[900].spans == ["email:9:40"] and not found[901].spans


def test_neighbours_are_told_apart(spark):
    """A telephone number right before a card number: together neither rule takes them, so the labelers' spans do."""
    rows = [f"reach me at +1 (605) 555-{1000 + i} 4078918989542{100 + i} or so" for i in range(200)]
    rows += [f"call +1 (605) 555-{1000 + i} or pay by card 4111111111111111 here" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in personal_data(df).collect()}
    for i in range(200):
        card = holds("card", rows[i].split()[6])
        assert not found[i].base_spans
        assert found[i].spans == ["phone:12:29"] + ["card:30:46"] * card
        assert found[200 + i].n_phone == found[200 + i].n_card == 1
        assert found[200 + i].spans == found[200 + i].base_spans


def test_reliabilities_find_the_bad_labeler():
    """One labeler votes at random, the others are right nine times in ten."""
    patterns = []
    for truth, n in ((1, 500), (-1, 500)):
        for wrong in range(-1, len(personal.LABELERS)):
            for coin in (1, -1):
                votes = [-truth if k == wrong else truth for k in range(len(personal.LABELERS))]
                votes[1] = coin
                votes[0] = 0
                patterns.append((tuple(votes), (0, 0), n * (6 if wrong < 0 else 1)))
    merged: dict = {}
    for votes, features, n in patterns:
        merged[votes, features] = merged.get((votes, features), 0) + n
    counted = [(v, f, n) for (v, f), n in merged.items()]
    for (votes, _, _), p in zip(counted, personal.reliabilities(counted)):
        others = sum(votes[2:])
        assert abs(others) < 2 or (p > 0.5) == (others > 0)


def test_no_python_in_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = personal_data(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_matches_are_linear(spark):
    """A text of one kind of character costs no more than its length."""
    texts = [c * 200_000 for c in "a1.@+ -("] + ["1." * 100_000, "a@" * 100_000, "+1 " * 60_000, "(1" * 60_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = df.select(*[F.size(personal.matches(F.col("text"), personal.RULES[k], personal.NEEDED[k], 0)).alias(k) for k in KINDS])
    assert len(found.collect()) == len(texts)
