from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from caselake.llm.queries import captures
from caselake.llm.revisit import canonical_url, resolve_revisits

SCHEMA = (
    "record_id bigint, url string, captured_at bigint, kind string, etag string, last_modified string, "
    "headers map<string,string>, payload string"
)


@pytest.mark.parametrize(
    "url, page",
    [
        ("https://User@WWW.Example.org:443/A/b/?b=2&utm_source=x&a=1#top", "example.org/A/b?a=1&b=2"),
        ("http://example.org", "example.org"),
        (" example.org// ", "example.org"),
        ("http://example.org/?gclid=1", "example.org"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_urls(spark, url, page):
    row = spark.createDataFrame([(url,)], "url string").select(canonical_url(F.col("url")).alias("page")).first()
    assert row.page == page


def by_brute_force(records):
    """(record id, status, response id) per revisit; pages are compared as given."""
    out = []
    for r in records:
        if r[3] != "revisit":
            continue
        earlier = [x for x in records if x[3] == "response" and x[1] == r[1] and x[2] is not None and r[2] is not None and x[2] < r[2]]
        if not earlier or r[1] is None:
            out.append((r[0], "missing", None))
            continue
        x = max(earlier, key=lambda x: (x[2], x[0]))
        status = "unchecked"
        if r[4] is not None:
            status = "resolved" if r[4] == x[4] else "changed"
        elif r[5] is not None:
            status = "resolved" if r[5] == x[5] else "changed"
        out.append((r[0], status, None if status == "changed" else x[0]))
    return out


def test_against_brute_force(spark):
    rng = random.Random(4)
    records = []
    for i in range(1500):
        page = rng.choice(["hot.org/a"] * 5 + [f"p{rng.randrange(40)}.org/x", None])
        kind = rng.choice(["response", "revisit", "revisit", "request"])
        when = rng.choice([None, *[rng.randrange(400)] * 30])
        records.append((i, page, when, kind, rng.choice([None, "e1", "e2"]), rng.choice([None, "d1"]), {"n": str(i)}, f"p{i}"))
    df = spark.createDataFrame(records, SCHEMA).repartition(6)
    found = resolve_revisits(df)
    assert sorted(map(repr, ((r.record_id, r.status, r.response_id) for r in found.collect()))) == sorted(
        map(repr, by_brute_force(records))
    )
    assert found.filter("response_id IS NOT NULL AND payload <> concat('p', response_id)").count() == 0
    assert found.filter("(payload IS NULL) <> (response_id IS NULL)").count() == 0


def test_headers_are_merged_by_what_may_change(spark):
    response = {"Content-Type": "a", "ETag": "e", "Cache-Control": "old", "X": "1"}
    revisit = {"cache-control": "new", "content-type": "b", "Date": "d", "Set-Cookie": "c"}
    rows = [(1, "u", 1, "response", "e", None, response, "p"), (2, "u", 2, "revisit", 'W/e', None, revisit, None)]
    rows += [(3, "other", 2, "revisit", None, None, None, None), (1, "u", 1, "response", "e", None, response, "p")]
    found = {r.record_id: r for r in resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[2].status == "resolved" and found[2].payload == "p"
    assert found[2].headers == {"content-type": "a", "etag": "e", "cache-control": "new", "x": "1", "date": "d"}
    assert (found[3].status, found[3].headers, found[3].payload) == ("missing", {}, None)


def test_clashing_record_ids_keep_their_own_payloads(spark):
    """One record id at two addresses, and two responses that differ in nothing but the payload."""
    rows = [
        (1, "a.org/x", 1, "response", "e1", None, {}, "AAA"),
        (1, "z.org/x", 1, "response", "e2", None, {}, "ZZZ"),
        (2, "a.org/x", 2, "revisit", "e1", None, {}, None),
        (3, "z.org/x", 2, "revisit", None, None, {}, None),
        (4, "c.org/x", 1, "response", None, None, {}, "one"),
        (4, "c.org/x", 1, "response", None, None, {}, "two"),
        (5, "c.org/x", 2, "revisit", None, None, {}, None),
        (6, "c.org/x", 3, "revisit", None, None, {}, None),
    ]
    found = {r.record_id: r.payload for r in resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (found[2], found[3]) == ("AAA", "ZZZ") and found[5] == found[6] and found[5] in ("one", "two")


def test_empty_tables_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert resolve_revisits(empty).count() == 0
    rows = [(1, "u", 1, "response", None, None, None, None), (2, "u", 2, "revisit", None, None, None, None)]
    wide = spark.createDataFrame(rows, SCHEMA)
    for name in ("page", "part", "found", "carried", "status", "tie"):
        wide = wide.withColumn(name, F.lit(0))
    assert [(r.status, r.response_id) for r in resolve_revisits(wide).collect()] == [("unchecked", 1)]


def test_made_captures_grow_with_the_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    made = captures(pages)
    assert made.count() == 3 * pages.count() and made.select("record_id").distinct().count() == made.count()
