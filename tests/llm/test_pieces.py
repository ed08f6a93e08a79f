from __future__ import annotations

import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from caselake.llm import pieces
from caselake.llm.pieces import PieceEncoder, decode_pieces, encode_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def strange_texts():
    rng = random.Random(3)
    letters = " \n\t  abtheing.é'sS1 ́-ÀÅİß世\r<s>①\x00😀0x0A"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["".join(rng.choice("abtheion") for _ in range(n)) for n in (127, 128, 129, 400, 2000)]
    return texts + [" " * n for n in range(40)] + ["a" * 1000, "", "the" * 500, "x" * 3 + " " * 300]


def test_same_ids_as_the_library_and_exact_round_trip(monkeypatch):
    library, texts = sentencepiece.SentencePieceProcessor(model_file=MODEL), strange_texts()
    expected = library.encode(texts)
    for indexed in (pieces.INDEXED, 500):
        monkeypatch.setattr(pieces, "INDEXED", indexed)
        encoder = PieceEncoder(MODEL)
        found = encoder.encode(texts)
        assert [ids.tolist() for ids in found] == expected
        assert [encoder.decode(ids) for ids in found] == texts


def test_documents(spark, sf_dir, docs, clashing, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for df in (docs, clashing.drop("pieces"), spark.read.parquet(f"{sf_dir}/documents.parquet")):
        encoded = encode_pieces(df, MODEL)
        both = decode_pieces(encoded, MODEL, into="again")
        assert encoded.columns == [*df.columns, "pieces"]
        assert both.filter(F.coalesce("text", F.lit("")) != F.col("again")).count() == 0
        for row in encoded.select("text", "pieces").collect():
            assert row.pieces == library.encode(row.text or "")
    assert encode_pieces(no_docs, MODEL).count() == 0
    assert dict(encode_pieces(clashing, MODEL).dtypes)["pieces"] == "array<int>"
    assert decode_pieces(spark.createDataFrame([(None,)], "pieces array<int>"), MODEL).first().text == ""
