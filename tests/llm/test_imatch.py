from __future__ import annotations

import hashlib
from collections import Counter

import regex
import xxhash
from pyspark.sql import functions as F

from caselake.llm.imatch import DIGITS, DRAWS, SUBSETS, fingerprints, lexicon, with_next


def parts(fingerprint):
    return [fingerprint[i * DIGITS : (i + 1) * DIGITS] for i in range(SUBSETS)]


def likeness(a, b):
    pairs = [(x, y) for x, y in zip(parts(a), parts(b)) if x != "." * DIGITS or y != "." * DIGITS]
    return sum(x == y for x, y in pairs) / len(pairs)


def test_edited_texts_and_likeness_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = {r.doc_id: r for r in fingerprints(docs).collect()}
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    assert len(found) == len(rows)
    prints = {}
    for (doc, text), (following, then) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + then[:half]
        row = found[doc]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.near_edited == likeness(row.fingerprint, row.edited_fingerprint)
        assert row.near_next == likeness(row.fingerprint, found[following].fingerprint)
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        prints.setdefault(edited, row.edited_fingerprint)
    assert len(set(prints.values())) > 0.9 * len(prints)
    near = [r.near_edited for r in found.values()]
    assert sum(near) > 10 * sum(r.near_next for r in found.values())


def hash64(raw, seed=42):
    return xxhash.xxh64_intdigest(raw, seed=seed)


def number(n):
    return n.to_bytes(8, "little")


def words(text):
    return {w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}


def plain(text, band):
    """The fingerprint of a text, subset by subset."""
    hashes = [hash64(w.encode()) for w in words(text) if w in band]
    if not hashes:
        state = 42
        for h in sorted((hash64(w.encode()) for w in words(text)), key=lambda h: h - 2**64 if h >= 2**63 else h):
            state = hash64(number(h), state)
        state = state if words(text) else hash64(text.encode())
        return f"{hash64(number(state)):016X}"[-DIGITS:] * SUBSETS
    bits = SUBSETS.bit_length() - 1
    members = {}
    for h in hashes:
        for draw in range(DRAWS):
            turn = draw * bits
            member = (h << turn | h >> (64 - turn)) % 2**64
            members.setdefault((member ^ 2**63) >> (64 - bits), []).append(member)
    out = ""
    for subset in range(SUBSETS):
        if subset not in members:
            out += "." * DIGITS
            continue
        state = None
        for member in sorted(members[subset]):
            seed = hash64(subset.to_bytes(4, "little") if state is None else number(state))
            state = hash64(number(member), seed)
        out += f"{state:016X}"[-DIGITS:]
    return out


def test_fingerprints_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, None), (-2, "..."), (-3, "Zzyzx\u00c9 qwv")], docs.schema))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    held = Counter(w for text in texts.values() for w in words(text))
    band = {w for w, n in held.items() if 0.01 <= n / len(texts) <= 0.2}
    found = {r.doc_id: r.fingerprint for r in fingerprints(docs, 0.01, 0.2).collect()}
    assert found == {doc: plain(text, band) for doc, text in texts.items()}


def test_the_lexicon_is_a_band_of_document_frequencies(spark):
    texts = [f"all rare{i} half{i % 2} Half{i % 2}" for i in range(100)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    words = ["all", "half0", "half1", "rare1"]
    hashes = {w: spark.sql(f"SELECT xxhash64('{w}')").first()[0] for w in words}
    assert {r.term for r in lexicon(docs, 0.02, 0.6).collect()} == {hashes["half0"], hashes["half1"]}


def test_edge_rows(spark, docs, clashing, no_docs):
    rows = fingerprints(docs).collect()
    assert len(rows) == docs.count() and all(len(r.fingerprint) == SUBSETS * DIGITS for r in rows)
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    empty = {r.fingerprint for r in rows if r.doc_id in (3, 4)}
    assert len(empty) == 1 and all(r.n_chars == 0 for r in rows if r.doc_id in (3, 4))
    assert fingerprints(no_docs).count() == 0 and fingerprints(clashing).count() == len(rows)
    single = fingerprints(docs.filter("doc_id = 1")).first()
    assert single.near_next == 1.0


def test_every_document_meets_the_next_one(spark):
    docs = spark.range(500).select(F.col("id").alias("d"), F.col("id").cast("string").alias("t"))
    found = with_next(docs, F.col("d"), F.col("t")).filter("NOT guest").collect()
    assert {(r.doc, int(r.next)) for r in found} == {(i, (i - 1) % 500) for i in range(500)}


def test_the_main_path_is_built_in(spark, docs):
    plan = fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
