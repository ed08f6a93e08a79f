from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from caselake.llm.packing import pack, plan

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed, size, window", [(0, 0, 64), (1, 1, 64), (2, 500, 64), (3, 20_000, 256), (4, 30, 256)])
def test_plans_place_every_document_once_and_overfill_nothing(seed, size, window):
    rng = np.random.default_rng(seed)
    counts = np.bincount(rng.integers(1, window, size), minlength=window)
    p = plan(counts, window)
    lengths = np.repeat(np.arange(window), counts)
    filled = {}
    for place, n in enumerate(lengths):
        at = np.searchsorted(p.starts, place, side="right") - 1
        assert p.length[at] == n
        member = place - p.starts[at]
        sequence = p.sequence[at] + member // p.each[at]
        filled.setdefault(int(sequence), []).append((int(p.offset[at] + member % p.each[at] * n), int(n)))
    assert sorted(filled) == list(range(p.sequences))
    for pieces in filled.values():
        end = 0
        for offset, n in sorted(pieces):
            assert offset == end
            end += n
        assert end <= window
    if size > 10_000:
        assert lengths.sum() > 0.99 * window * p.sequences


def pieces_of(spark, df, window):
    return [r.asDict() for r in pack(df, PATH, 2, window, keep_ids=True).collect()]


def test_pieces_hold_every_id_once(spark, docs, clashing):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    for df in (docs, clashing):
        found = pieces_of(spark, df, 64)
        whole = {}
        for p in sorted(found, key=lambda p: p["start"]):
            ids = np.frombuffer(p["ids"], "<u4")
            assert len(ids) == p["length"] <= 64 and p["ids_crc32"] == zlib.crc32(p["ids"])
            whole.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], ids.tolist()))
        rows = [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in docs.collect()]
        assert sum(p["length"] for p in found) == sum(len(ids) for _, ids in rows)
        for doc, ids in rows:
            if sum(d == doc and len(i) == len(ids) for d, i in rows) == 1:
                assert [x for _, part in whole[doc, len(ids)] for x in part] == ids
        by_sequence = {}
        for p in found:
            by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        assert sorted(by_sequence) == list(range(len(by_sequence)))
        for parts in by_sequence.values():
            ends = np.cumsum([n for _, n in sorted(parts)])
            assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 64


def test_no_documents(spark, no_docs):
    assert pieces_of(spark, no_docs, 64) == []
