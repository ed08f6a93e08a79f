from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from caselake.llm.tokens import Encoder

NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
PARTS = [
    "word", "WORD", "Éré", "straße", "STRASSE", "ÿþ", "×", "÷", "ªº", "µm", "İstanbul", "œuvre", "Σίσυφος", "日本", "é",
    "it's", "I'LL", "'s", "x1y2", "42", "v2.0", "!!", "***", "###", "(", ")", "_", "`", "~", "<|endoftext|>", "</w>", "Ġ", "\n", "\n\n", " ",
    "  ", "a.b,c", "end.", "end?!", "'", '"', "-", "a-b", "[x]", "{y}", "é.", "Ünder%%%", "a" * 70,
]


def library(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
def test_ids_are_those_of_whole_texts(name):
    draw, whole, encoder = random.Random(5), library(name), Encoder(public_tokenizers.path(name))
    encoder.most_kept = 300  # forgets now and then
    for _ in range(30):
        texts = [draw.choice(["", " "]).join(draw.choices(PARTS, k=draw.randrange(30))) for _ in range(20)]
        assert [ids.tolist() for ids in encoder.encode(texts)] == [whole(text) for text in texts]


@pytest.mark.parametrize("name", NAMES)
def test_new_words_go_to_the_tokenizer_many_at_a_time(name, monkeypatch):
    encoder, whole, given = Encoder(public_tokenizers.path(name)), library(name), []
    plain = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda texts: given.extend(texts) or plain(texts))
    draw = random.Random(6)
    words = {"".join(draw.choices("abcdeéèßü", k=8)) for _ in range(3200)}
    text = " " + " ".join(word + draw.choice(["", ",", "!!", "%%%"]) for word in words)
    assert encoder.encode([text])[0].tolist() == whole(text)
    assert len(given) < len(words) / 20


def test_capitals_of_latin_1_are_the_same_word(monkeypatch):
    encoder, whole = Encoder(public_tokenizers.path(NAMES[0])), library(NAMES[0])
    texts = ["éré ñoño über", "ÉRÉ ÑOÑO ÜBER", "Éré Ñoño Über"]
    assert [ids.tolist() for ids in encoder.encode(texts)] == [whole(text) for text in texts]
    assert len(encoder._known) == 3


def test_a_failure_leaves_no_chunk_half_learned(monkeypatch):
    encoder, whole = Encoder(public_tokenizers.path(NAMES[1])), library(NAMES[1])
    before = encoder.encode(["one two"])[0]
    with monkeypatch.context() as broken, pytest.raises(MemoryError):
        broken.setattr(encoder, "_chunk_ids", lambda chunks: (_ for _ in ()).throw(MemoryError()))
        encoder.encode(["one two three"])
    assert np.array_equal(before, encoder.encode(["one two"])[0])
    assert encoder.encode(["three two"])[0].tolist() == whole("three two")
