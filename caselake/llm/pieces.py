"""SentencePiece encoding by suffix-array matching, and decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from caselake.llm.tokens import ChunkEncoder, in_groups

SPACE = "▁"
# No piece of these vocabularies has a space after another character, so no merge crosses that place.
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Characters that one suffix array indexes; a longer chunk has one of its own.
INDEXED = 400_000
# Rows that leave a task together, so that no more than their ids and texts are held.
ROWS_TOGETHER = 1024
# Chunks up to this length are merged side by side, longer ones with a queue each.
SIDE_BY_SIDE = 128
_NEVER = np.int64(1) << np.int64(30)


class PieceEncoder(ChunkEncoder):
    """Ids of a byte-pair vocabulary with byte fallback, as its SentencePiece file defines them."""

    most_kept = 600_000

    def __init__(self, path: str) -> None:
        super().__init__()
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        texts = [model.id_to_piece(i) for i in plain]
        if any(SPACE in t.lstrip(SPACE) for t in texts):
            raise ValueError("a piece has a space after another character")
        self.bytes_at = np.zeros(256, np.uint32)
        self.written = [b""] * len(every)
        for i in every:
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.bytes_at[value], self.written[i] = i, bytes([value])
        for i, text in zip(plain, texts):
            self.written[i] = text.replace(SPACE, " ").encode()
        scores = np.array([model.get_score(i) for i in plain])
        # The best score is 0; equal scores share a rank.
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.id = np.array(plain, np.uint32)
        self.size = np.array(list(map(len, texts)), np.int64)
        self.longest = int(self.size.max())
        self.texts = np.array(texts, f"U{self.longest}")
        self.past = np.array([t + chr(0x10FFFF) * (self.longest - len(t)) for t in texts], f"U{self.longest}")

    def _chunks(self, text: str) -> list[str]:
        return _CHUNK.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes, held, size = [np.empty(0, np.uint32)], [np.empty(0, np.int64)], [], 0
        for text in [*texts, None]:
            if held and (text is None or size + len(text) > INDEXED):
                found, n = self._match(held)
                ids.append(found)
                sizes.append(n)
                held, size = [], 0
            if text is not None:
                held.append(text)
                size += len(text) + 1
        return np.concatenate(ids), np.concatenate(sizes)

    def _suffixes(self, points: np.ndarray) -> np.ndarray:
        """Positions in the order of what follows them, as far as the longest piece looks; by doubling."""
        rank = np.unique(points, return_inverse=True)[1].astype(np.int64) + 1
        seen = 1
        while True:
            ahead = np.zeros_like(rank)
            ahead[: max(0, len(rank) - seen)] = rank[seen:]
            key = (rank << np.int64(32)) | ahead
            order = np.argsort(key, kind="stable")
            seen *= 2
            if seen >= self.longest:
                return order
            steps = np.diff(key[order]) != 0
            rank[order] = np.concatenate([[0], np.cumsum(steps)]) + 1

    def _edges(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All places where a piece occurs, sorted by position and length, and the piece there."""
        order = self._suffixes(points)
        padded = np.concatenate([points, np.zeros(self.longest, np.uint32)])
        ahead = np.lib.stride_tricks.sliding_window_view(padded, self.longest)[order]
        suffixes = np.ascontiguousarray(ahead).view(f"U{self.longest}").ravel()
        low = np.searchsorted(suffixes, self.texts, side="left")
        high = np.searchsorted(suffixes, self.past, side="right")
        times = np.maximum(0, high - low)
        piece = np.repeat(np.arange(len(times)), times)
        at = np.arange(times.sum()) + np.repeat(low - np.cumsum(times) + times, times)
        key = order[at] * np.int64(64) + self.size[piece]
        by_place = np.argsort(key, kind="stable")
        return key[by_place], piece[by_place]

    def _match(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # A line break of its own kind stands between texts: a code point that text cannot hold.
        joined = "\ud800".join(texts) + "\ud800"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        # A zero is not told from the end of a string by numpy, so it is moved where no piece has a character.
        points = np.where(points == 0, np.uint32(0xD801), points)
        keys, pieces = self._edges(points)

        def piece_at(start: np.ndarray, size: np.ndarray) -> np.ndarray:
            """The piece of exactly this place, or -1."""
            wanted = start * 64 + np.minimum(size, 63)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            return np.where(keys[at] == wanted, pieces[at], -1) if len(keys) else np.full(len(start), -1)

        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        firsts = np.cumsum(lengths + 1) - lengths - 1
        start, size = self._merge(firsts, lengths, piece_at)
        piece = piece_at(start, size)
        owner = np.searchsorted(firsts, start, side="right") - 1
        return self._written_out(points, start, piece, owner, len(texts))

    def _merge(self, firsts, lengths, piece_at) -> tuple[np.ndarray, np.ndarray]:
        """Best-ranked neighbours become one, leftmost first, until no two make a piece; for all texts at once."""

        def ranks(start: np.ndarray, size: np.ndarray) -> np.ndarray:
            piece = piece_at(start, size)
            return np.where(piece >= 0, self.rank[piece], _NEVER)

        done = [self._merge_long(f, n, ranks) for f, n in zip(firsts, lengths) if n > SIDE_BY_SIDE]
        short = lengths <= SIDE_BY_SIDE
        first, n = firsts[short], lengths[short]
        text = np.repeat(np.arange(len(n)), n)
        start = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        size = np.ones(len(start), np.int64)
        rank = self._pair_ranks(start, size, text, np.arange(len(start)), ranks)
        while len(start):
            heads = np.flatnonzero(np.diff(text, prepend=-1))
            best = np.minimum.reduceat(rank * len(rank) + np.arange(len(rank)), heads)
            left = best % len(rank)
            merging = rank[left] < _NEVER
            counts = np.diff(heads, append=len(text))
            going = np.repeat(merging, counts)
            if not going.all():
                done.append((start[~going], size[~going]))
            left = left[merging]
            size[left] += size[left + 1]
            rank[left + 1] = -1
            keep = going & (rank >= 0)
            moved = np.cumsum(keep) - 1
            left = moved[left]
            start, size, text, rank = start[keep], size[keep], text[keep], rank[keep]
            before = left - 1
            before = before[(before >= 0)]
            changed = np.concatenate([left, before])
            if len(changed):
                rank[changed] = self._pair_ranks(start, size, text, changed, ranks)
        start = np.concatenate([s for s, _ in done]) if done else np.empty(0, np.int64)
        size = np.concatenate([s for _, s in done]) if done else np.empty(0, np.int64)
        order = np.argsort(start, kind="stable")
        return start[order], size[order]

    @staticmethod
    def _pair_ranks(start, size, text, at, ranks) -> np.ndarray:
        """The rank of what each segment of ``at`` and the next one make; none at the end of a text."""
        following = np.minimum(at + 1, len(start) - 1)
        same = (following > at) & (text[following] == text[at])
        return np.where(same, ranks(start[at], size[at] + size[following]), _NEVER)

    @staticmethod
    def _merge_long(first: int, n: int, ranks) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long text, with a queue of candidate pairs."""
        start = np.arange(first, first + n)
        size = [1] * n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = ranks(start[:-1], np.full(n - 1, 2)).tolist()
        queue = [(r, i, 2) for i, r in enumerate(pairs) if r < _NEVER]
        heapq.heapify(queue)
        while queue:
            _, i, total = heapq.heappop(queue)
            j = after[i]
            if not size[i] or j >= n or size[i] + size[j] != total:
                continue
            size[i], size[j], after[i] = total, 0, after[j]
            if after[i] < n:
                before[after[i]] = i
            around = [(k, size[k] + size[after[k]]) for k in (before[i], i) if k >= 0 and after[k] < n]
            if around:
                found = ranks(start[[k for k, _ in around]], np.array([t for _, t in around]))
                for (k, t), r in zip(around, found.tolist()):
                    if r < _NEVER:
                        heapq.heappush(queue, (r, k, t))
        sizes = np.array(size, np.int64)
        return start[sizes > 0], sizes[sizes > 0]

    def _written_out(self, points, start, piece, owner, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids per text; a character that is no piece becomes its bytes."""
        known = piece >= 0
        if known.all():
            return self.id[piece], np.bincount(owner, minlength=texts)
        lone = points[start[~known]]
        lone = np.where(lone == 0xD801, 0, lone)
        raw = [chr(c).encode() for c in lone.tolist()]
        each = np.ones(len(piece), np.int64)
        each[~known] = list(map(len, raw))
        ids = np.repeat(np.where(known, self.id[np.maximum(piece, 0)], 0), each)
        ids[np.repeat(~known, each)] = self.bytes_at[np.frombuffer(b"".join(raw), np.uint8)]
        return ids.astype(np.uint32), np.bincount(owner, weights=each, minlength=texts).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``, without the space that encoding puts first."""
        text = b"".join(map(self.written.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_TOGETHER):
            yield batch.slice(start, ROWS_TOGETHER)


def encode_pieces(docs: DataFrame, model: str, text_column: str = "text", into: str = "pieces") -> DataFrame:
    """``docs`` with the array ``into`` of piece ids of ``text_column``; null and empty text have none.

    Within a task, the distinct chunks of a batch that are not remembered are
    joined and indexed by a suffix array. A binary search for every piece gives
    the ranges where it occurs; these edges are sorted by position, and
    neighbouring segments with an edge over both are merged, best score first.
    Rows are independent; a column of the name ``into`` is replaced.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = piece_encoder(model).encode
        for batch in _in_slices(batches):
            texts = [t or "" for t in batch.column(text_column).to_pylist()]
            found = [ids for group in in_groups(texts, 4_000_000) for ids in known(group)]
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate([np.empty(0, np.uint32), *found]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), lists], names=[*passed, into])

    passed = [c for c in docs.columns if c != into]
    fields = [f for f in docs.schema.fields if f.name != into]
    return docs.mapInArrow(encode, StructType([*fields, StructField(into, ArrayType(IntegerType()))]))


def decode_pieces(docs: DataFrame, model: str, pieces_column: str = "pieces", into: str = "text") -> DataFrame:
    """``docs`` with the text ``into`` of the ids in ``pieces_column``; a null array is the empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = piece_encoder(model)
        for batch in _in_slices(batches):
            lists = batch.column(pieces_column)
            texts = [known.decode(ids.values.to_numpy()) if ids.is_valid else "" for ids in lists]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in passed), pa.array(texts, pa.string())], names=[*passed, into]
            )

    passed = [c for c in docs.columns if c != into]
    fields = [f for f in docs.schema.fields if f.name != into]
    return docs.mapInArrow(decode, StructType([*fields, StructField(into, StringType())]))
