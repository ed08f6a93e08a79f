from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from caselake.llm import alignment
from caselake.llm.alignment import aligned_tokens
from caselake.llm.queries import op13_cross_tokenizer_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_table() -> dict[str, int]:
    table, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def expected(rows):
    """Whole texts through both libraries, all pairs of a text's tokens by their byte ranges."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = byte_table()

    def spans(parts):
        ends, at = [], 0
        for part in parts:
            ends.append((at, at + len(part)))
            at += len(part)
        return ends

    figures, total = [], Counter()
    for doc_id, text in rows:
        whole = f" {text or ''}"
        ids_a = first.encode(whole, add_special_tokens=False).ids if text else []
        ids_b = second.encode(text) if text else []
        parts_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in ids_a]
        names_b = [second.id_to_piece(i) for i in ids_b]
        parts_b = [
            bytes([int(n[3:5], 16)]) if second.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(ids_b, names_b)
        ]
        if b"".join(parts_a) != whole.encode() or b"".join(parts_b) != whole.encode():
            figures.append((doc_id, [], [], [], []))
            continue
        spans_a, spans_b = spans(parts_a), spans(parts_b)
        links, low = [], 0
        for n, (start, end) in enumerate(spans_a):
            while spans_b[low][1] <= start:
                low += 1
            m = low
            while m < len(spans_b) and spans_b[m][0] < end:
                links.append((ids_a[n], ids_b[m]))
                m += 1
        total.update(links)
        cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups, start = [], 0
        for cut in cuts:
            groups.append(
                ",".join(str(i) for i, (s, e) in zip(ids_a, spans_a) if start <= s and e <= cut)
                + "|"
                + ",".join(str(i) for i, (s, e) in zip(ids_b, spans_b) if start <= s and e <= cut)
                if len(cuts) < 400
                else None
            )
            start = cut
        figures.append((doc_id, ids_a, ids_b, groups, links))
    best = {}
    for (a, b), n in total.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc_id, ids_a, ids_b, groups, links in figures:
        written = ";".join(groups) if None not in groups else None
        hashed = "" if not ids_a else written and hashlib.sha256(written.encode()).hexdigest()
        n_best = sum(total[x] == best[x[1]] for x in links)
        out.append((doc_id, len(ids_a), len(ids_b), len(groups), len(links), n_best, sum(total[x] for x in links), hashed))
    return out


def compare(df, rows):
    mine = sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)
    theirs = sorted(expected(rows), key=repr)
    assert [m[:-1] for m in mine] == [t[:-1] for t in theirs]
    # The plain way of writing groups is slow, so it is left to short texts.
    assert all(t[-1] is None or m[-1] == t[-1] for m, t in zip(mine, theirs))


def test_query_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    compare(op13_cross_tokenizer_alignment(spark, sf_dir), [tuple(r) for r in rows])


ODD = [
    "<|endoftext|> <s> </s><unk>",
    "▁ a piece's own space",
    "  two  blanks \n\t and\r\n more   ",
    "𝔘𝔫𝔦 ☃ ñandú 中文字 \u0000 zero",
    "é" * 50,
    " ",
    "<0x41>",
    "a b c　d",
]


@pytest.mark.parametrize("lane", [1024, 4])
def test_edge_cases(spark, docs, no_docs, clashing, monkeypatch, lane):
    """Odd texts beside the usual ones; lanes of a few tokens as well."""
    monkeypatch.setattr(alignment, "LANE", lane)
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    every = docs.union(more)
    rows = [tuple(r) for r in every.collect()]
    compare(aligned_tokens(every, A, B), rows)
    assert sorted(map(repr, aligned_tokens(clashing, A, B).collect())) == sorted(map(repr, aligned_tokens(docs, A, B).collect()))
    empty = aligned_tokens(no_docs, A, B)
    assert empty.columns == COLUMNS and not empty.collect()


def test_lanes_of_a_long_text():
    """A long text goes on in several lanes and gives the same links, cuts and groups."""
    texts = ["some words of one text, " * 900, "x" * 5000]
    whole = alignment._align(texts, A, B)
    before, alignment.LANE = alignment.LANE, 10**9
    try:
        one = alignment._align(texts, A, B)
    finally:
        alignment.LANE = before
    for name, value in one.items():
        assert value == whole[name] if isinstance(value, (bytes, list)) else (value == whole[name]).all()
