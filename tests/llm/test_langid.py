from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from caselake.llm import langid
from caselake.llm.langid import fit, identify, learnable, subwords


def test_held_out_accuracy_and_what_is_kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs)
    found = identify(docs, model).select("doc_id", "text", "lang", "lang_pred", "score", "rejected").toPandas()
    held = found[[zlib.crc32(str(d).encode()) % 5 == 0 for d in found.doc_id]]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert found.rejected.mean() < 0.02 and found.score.between(0, 1).all()


def test_rows_not_to_learn_from_are_not_looked_at(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    swapped = docs.withColumn("lang", F.when(learnable(F.col("doc_id")), F.col("lang")).otherwise("xx"))
    one, other = fit(docs), fit(swapped)
    assert one.languages == other.languages and np.array_equal(one.table, other.table)
    share = docs.filter(learnable(F.col("doc_id"))).count() / docs.count()
    assert 0.7 < share < 0.9


def test_texts_without_letters_are_unknown_and_rejected(spark, docs, clashing, no_docs, sf_dir):
    model = fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = spark.createDataFrame([(1, None), (2, ""), (3, " 12 .,! "), (4, "das ist die"), (5, "x")], "doc_id int, text string")
    found = {r.doc_id: r for r in identify(rows, model).collect()}
    assert all((found[i].lang_pred, found[i].score, found[i].rejected) == ("und", 0.0, True) for i in (1, 2, 3))
    assert all(found[i].lang_pred in model.languages for i in (4, 5))
    wide = identify(clashing.withColumn("lang_pred", F.lit(1)), model)
    assert wide.count() == docs.count() and dict(wide.dtypes)["lang_pred"] == "string" and wide.first()["row"] == "own row"
    assert identify(no_docs, model).count() == 0


def test_without_labels_nothing_is_known(spark, docs):
    model = fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert model.languages == [] and identify(docs, model).filter("lang_pred <> 'und'").count() == 0


def test_only_a_bounded_number_is_drawn(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(langid, "PER_LANGUAGE", 3)
    seen = []
    monkeypatch.setattr(langid, "_fit_rows", lambda rows: seen.append(rows))
    fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert seen[0].groupby("lang").size().max() == 3


def test_subwords_see_letters_only():
    assert subwords("1 2") is None and subwords(None) is None
    assert np.array_equal(subwords("Ab-1 c"), subwords("ab   c"))
    assert len(subwords("a")) == 3
