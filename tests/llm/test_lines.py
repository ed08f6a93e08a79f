from __future__ import annotations

import duckdb
import pytest

from caselake.llm import oracle
from caselake.llm.lines import drop_shared_lines

SHARED = "This line is long enough to be shared by many documents."


def by_brute_force(rows, min_chars, min_docs):
    """Over ``(doc_id, text)``: rows of (doc_id, text, n_lines, n_dropped)."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(low)

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    lost_by = {
        k: max((d for d in docs if d is not None), default=None)
        for k, docs in holders.items()
        if len(k) >= min_chars and len(docs) >= min_docs
    }
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in lost_by or lost_by[key(x)] == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


ROWS = [
    *[(i, f"start {i}\n  {SHARED.upper() if i % 2 else SHARED}\t\n{SHARED}\nend") for i in range(7)],
    (6, "another text of six\n" + SHARED),
    (None, SHARED),
    (20, None),
    (21, ""),
    (22, "\n\n"),
    (23, "É" * 39 + "\n" + "É" * 40),
    *[(i, "É" * 40 + "\n" + "é" * 40 + "\nx") for i in range(30, 34)],
    (40, "a\n" * 30_000 + SHARED),
    (40, "a\n" * 30_000 + SHARED),
]


@pytest.mark.parametrize("min_chars, min_docs", [(40, 5), (1, 2)])
def test_against_brute_force(spark, min_chars, min_docs):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(5)
    found = drop_shared_lines(df, min_chars, min_docs).select("doc_id", "text", "n_lines", "n_dropped")
    expected = by_brute_force(ROWS, min_chars, min_docs)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_sql_states_the_same(spark):
    rows = [r for r in ROWS if r[0] is not None and r[0] not in (6, 40)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    theirs = con.sql(f"SELECT doc_id, kept, n_lines, n_dropped FROM ({oracle.LINE_DEDUP.format(documents='documents')})")
    assert sorted(theirs.fetchall()) == sorted(by_brute_force(rows, 40, 5))


def test_other_columns_pass_and_clashing_ones_are_replaced(spark, docs, clashing, no_docs):
    found = drop_shared_lines(clashing, 5, 2)
    assert found.columns == [*clashing.columns, "n_dropped"] and dict(found.dtypes)["n_lines"] == "bigint"
    assert found.filter("key = 'own key' AND row = 'own row'").count() == docs.count()
    assert drop_shared_lines(no_docs).count() == 0
    assert drop_shared_lines(docs.select("text", "doc_id")).columns == ["text", "doc_id", "n_lines", "n_dropped"]


def test_the_main_path_is_built_in(spark, docs):
    plan = drop_shared_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
