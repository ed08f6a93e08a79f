from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from caselake.llm import queries as Q
from caselake.session import stage
from tests.llm.test_lines import by_brute_force as shared_lines
from tests.llm.test_minhash import by_brute_force as near_groups
from caselake.llm.minhash import Near


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "12 34", "en", "s", 5)], docs.schema)
    rows = [docs.unionByName(extra)]
    for _, step in corpus_pipeline.STAGES:
        rows.append(stage(step(spark, rows[-1], sf_dir)))
    start, language, lines, near, packed = rows
    for part in rows[1:4]:
        assert part.columns == docs.columns and dict(part.dtypes) == dict(docs.dtypes)

    kept = {r.doc_id for r in language.collect()}
    assert 10**6 not in kept and 10**6 + 1 not in kept and len(kept) >= 0.98 * docs.count()

    texts = [(r.doc_id, r.text) for r in language.collect()]
    expected = {(d, t) for d, t, _, _ in shared_lines(texts, 40, 5)}
    assert {(r.doc_id, r.text) for r in lines.collect()} == expected
    assert lines.filter("n_chars <> char_length(text)").count() == 0

    texts = sorted((r.doc_id, r.text) for r in lines.collect())
    groups = near_groups(texts, Near(words=5, percent=80))
    assert sorted(r.doc_id for r in near.collect()) == [d for (d, _), c in zip(texts, groups) if c == d]

    pieces = packed.groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in near.collect()}
    assert packed.filter("length > 4096 OR offset + length > 4096").count() == 0


def test_columns_of_any_name_pass_through(spark, clashing):
    """Each filtering stage gives back the columns it got, with the values they had."""
    names = ["version", "kept_id", "score", "lang_pred", "rejected", "n_lines", "n_dropped", "rows", "__row", "n_shingles"]
    docs = clashing.selectExpr("*", "'en' AS lang", "'s' AS source", "1L AS n_chars").withColumns(
        {name: F.lit(f"own {name}") for name in names}
    )
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, docs, "")
        assert kept.columns == docs.columns and dict(kept.dtypes) == dict(docs.dtypes)
        rows = kept.collect()
        assert rows and all(r[name] == f"own {name}" for r in rows for name in names)
    assert corpus_pipeline.packing(spark, docs, "").count() >= docs.count()


def test_of_repeated_rows_one_stays(spark, docs):
    wide = docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    kept = corpus_pipeline.near_dedup(spark, wide, "")
    ids = sorted((r.doc_id or -1) for r in kept.collect())
    assert ids.count(2) == 0 and ids.count(1) == 1 and ids.count(6) == 1


def test_every_query_reads_its_whole_table(spark, sf_dir):
    tables = {"op5": "pages", "op9": "pages", "op10": "embeddings"}
    times = {"op5": 2.25, "op3": None}
    for name, query in Q.queries().items():
        op = name.split("_")[0]
        rows = spark.read.parquet(f"{sf_dir}/{tables.get(op, 'documents')}.parquet").count()
        found = query(spark, sf_dir).count()
        if op == "op5":
            assert rows < found < times["op5"] * rows
        elif op == "op3":
            assert found >= rows
        elif op == "op11":
            assert found > 100
        else:
            assert found == rows
