"""Token ids of many texts, with the words that repeat encoded once. Runs inside tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

# White space and controls on which text patterns and Python may differ; such texts go whole to the tokenizer.
_UNUSUAL = (
    "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
)
# Marks that end words; after an ASCII letter or digit the vocabularies' patterns always begin anew.
_MARKS = ",.;:!?"
# A space or line break after anything else begins a new chunk; no vocabulary's pattern reaches over that place.
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_LONGEST_KEPT = 64
# A plain word, with the space before it, and marks that no vocabulary takes together with a letter before them.
_PLAIN = re.compile(r"( ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)")
# Plain words that go to the tokenizer as one text.
_TOGETHER = 32


class _Numbers(dict):
    """Chunks and their numbers; a chunk that is asked for the first time gets the next one and is listed as new."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


class ChunkEncoder:
    """Encodes texts chunk by chunk and remembers the ids of each distinct chunk, up to a bound.

    Between two calls of ``encode`` at most ``most_kept`` chunks are kept.

    Subclasses cut a text into chunks whose ids, in a row, are the text's, or
    say that a text has to be encoded whole.
    """

    most_kept = 700_000

    def __init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        self._known = _Numbers()
        self._flat, self._ends = np.empty(1 << 20, np.uint32), np.zeros(1 << 16, np.int64)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        raise NotImplementedError

    def _chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._ids(chunks)

    def _chunks(self, text: str) -> list[str] | None:
        raise NotImplementedError

    def _learn(self) -> None:
        new = self._known.new
        base = len(self._known) - len(new)
        ids, sizes = self._chunk_ids(new)
        start, end = self._ends[base], self._ends[base] + len(ids)
        while len(self._ends) <= base + len(new):
            self._ends = np.concatenate([self._ends, np.zeros_like(self._ends)])
        while len(self._flat) < end:
            self._flat = np.concatenate([self._flat, np.empty_like(self._flat)])
        self._ends[base + 1 : base + 1 + len(new)] = start + np.cumsum(sizes)
        self._flat[start:end] = ids
        self._known.new = []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        try:
            return self._encoded(texts)
        except BaseException:
            # Some chunks may have a number, but no ids.
            self._forget()
            raise

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self._chunks(text) for text in texts]
        whole = iter(self._split(*self._ids([t for t, c in zip(texts, cut) if c is None])))
        counts = [len(c) for c in cut if c is not None]
        at = np.fromiter(map(self._known.__getitem__, chain.from_iterable(c for c in cut if c)), np.int64, sum(counts))
        if self._known.new:
            self._learn()
        starts, sizes = self._ends[at], self._ends[at + 1] - self._ends[at]
        ends = np.cumsum(sizes)
        flat = self._flat.take(np.arange(sizes.sum()) + np.repeat(starts - ends + sizes, sizes))
        if len(self._known) > self.most_kept:
            self._forget()
        lasts = np.concatenate([[0], ends])[np.cumsum(counts, dtype=np.int64)]
        known = iter(self._split(flat, np.diff(lasts, prepend=0)))
        return [next(whole) if c is None else next(known) for c in cut]

    @staticmethod
    def _split(flat: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


def in_groups(texts: Iterable[str], most: int = 2_000_000) -> Iterator[list[str]]:
    """Consecutive texts of about ``most`` characters together; every text is in one group."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _in_latin(text: str) -> bool:
    """Whether the text is in Latin-1, whose letters have one form only."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder(ChunkEncoder):
    """``encode`` of a ``tokenizers`` file without special tokens.

    A chunk is white space and the text up to the next one. The patterns by
    which these vocabularies cut text never take a character of a chunk
    together with the white space that follows it, so the ids of a text are
    those of its chunks in a row. Texts with unusual white space, and chunks
    of unusual length, are left to the tokenizer as they are.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        # Where white space is dropped, it need not be part of a chunk.
        self._bare = not len(self._ids(["\n \n"])[0])
        ids, _ = self._ids(["QuICK", "quick"])
        self._lower = bool(len(ids) % 2 == 0 and (ids[: len(ids) // 2] == ids[len(ids) // 2 :]).all())
        # Ids that are the last of a word, or the first of one after a space: by them words are told apart.
        suffix = getattr(self._tokenizer.model, "end_of_word_suffix", None) if self._bare else None
        names = self._tokenizer.get_vocab()
        border = [i for name, i in names.items() if (name.endswith(suffix) if suffix else name.startswith("\u0120"))]
        self._border = np.zeros(max(names.values()) + 1, bool)
        self._border[border] = bool(suffix) or not self._bare

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum()), sizes

    def _chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks that differ in the marks after a word only are encoded once, the marks by themselves."""
        number: dict[str, int] = {}
        words: list[str] = []
        others: list[str] = []
        parts = np.empty(2 * len(chunks), np.int64)
        for i, chunk in enumerate(chunks):
            plain = _PLAIN.fullmatch(chunk)
            if plain:
                core, tail = plain.groups()
            else:
                core = chunk.rstrip(_MARKS)
                cut = len(core) if core and core[-1].isascii() and core[-1].isalnum() else len(chunk)
                core, tail = chunk[:cut], chunk[cut:]
            for side, text in ((0, core), (1, tail)):
                at = number.get(text)
                if at is None:
                    # Words count upwards, all other parts downwards.
                    if plain and not side and (self._bare or text[0] == " "):
                        at = len(words)
                        words.append(text)
                    else:
                        others.append(text)
                        at = -len(others)
                    number[text] = at
                parts[2 * i + side] = at
        (ids, sizes), (more, last) = self._word_ids(words), self._ids(others[::-1])
        ids, sizes = np.concatenate([ids, more]), np.concatenate([sizes, last])
        parts[parts < 0] += len(sizes)
        ends = np.cumsum(sizes)
        each = sizes[parts]
        at = np.arange(each.sum()) + np.repeat(ends[parts] - np.cumsum(each), each)
        return ids[at], each.reshape(-1, 2).sum(axis=1)

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`_ids` of plain words; many go to the tokenizer as one text, which its pattern cuts between them."""
        glue = " " if self._bare else ""
        ids, sizes = self._ids([glue.join(words[i : i + _TOGETHER]) for i in range(0, len(words), _TOGETHER)])
        places = np.flatnonzero(self._border[ids])
        found = np.diff(places + 1, prepend=0) if self._bare else np.diff(places, append=len(ids))
        # Whatever tells no borders, or other ones, gets each word by itself.
        if len(found) != len(words) or found.sum() != len(ids):
            return self._ids(words)
        return ids, found

    def _chunks(self, text: str) -> list[str] | None:
        if any(c in text for c in _UNUSUAL):
            return None
        if self._bare:
            # The vocabulary is one of lower case, and in Latin-1 there is only one way to get there.
            chunks = (text.lower() if self._lower and _in_latin(text) else text).split()
        else:
            chunks = _CHUNK.findall(text)
        return chunks if max(map(len, chunks), default=0) <= _LONGEST_KEPT else None


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file; it keeps what it has learned from task to task."""
    return Encoder(path)
