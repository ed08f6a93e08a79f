"""Links between the tokens of two tokenizers over the same bytes."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.rows import text_of
from caselake.llm.tokens import ChunkEncoder, Encoder, in_groups
from caselake.session import shuffle_sized, size_in_bytes, stage

SPACE = "▁"
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Characters that are aligned together.
CHARACTERS = 2_000_000
# Tokens after which a long text may go on in another lane, and how far ahead a place for that is looked for.
LANE, AHEAD = 512, 256
# Chunks that a worker remembers for either tokenizer.
MOST_KEPT = 500_000
_NAME = "S6"


class _Pieces(ChunkEncoder):
    """Ids of a SentencePiece file, chunk by chunk: no piece has a space after another character."""

    def __init__(self, path: str) -> None:
        super().__init__()
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self._blank = [self._model.piece_to_id(SPACE)]

    def bytes_of_ids(self) -> list[bytes]:
        model = self._model
        every = range(model.get_piece_size())
        return [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace(SPACE, " ").encode()
            for i in every
        ]

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # The model puts the first space of each chunk back, unless nothing follows.
        found = self._model.encode([t[1:].replace(SPACE, " ") for t in texts], num_threads=1) if texts else []
        found = [ids if text != SPACE else self._blank for ids, text in zip(found, texts)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum()), sizes

    def _chunks(self, text: str) -> list[str]:
        return _CHUNK.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Side(NamedTuple):
    """One tokenizer: its encoder, the bytes of each id, and how many they are."""

    encode: ChunkEncoder
    written: list[bytes]
    size: np.ndarray


@lru_cache(maxsize=1)
def _sides(first: str, second: str) -> tuple[_Side, _Side]:
    from tokenizers import Tokenizer

    names, letters = Tokenizer.from_file(first).get_vocab(), _byte_letters()
    written_a = [b""] * (max(names.values()) + 1)
    for name, number in names.items():
        written_a[number] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
    words, pieces = Encoder(first), _Pieces(second)
    words.most_kept = pieces.most_kept = MOST_KEPT
    written_b = pieces.bytes_of_ids()
    sizes = [np.array(list(map(len, w)), np.int64) for w in (written_a, written_b)]
    return _Side(words, written_a, sizes[0]), _Side(pieces, written_b, sizes[1])


class Tokens(NamedTuple):
    """The tokens of several texts in a row: ids, where each ends in the joined bytes, and how many a text has."""

    ids: np.ndarray
    ends: np.ndarray
    counts: np.ndarray


def _tokens(found: list[np.ndarray], side: _Side) -> Tokens:
    ids = np.concatenate([np.empty(0, np.uint32), *found]).astype(np.int64)
    return Tokens(ids, np.cumsum(side.size[ids]), np.array(list(map(len, found)), np.int64))


def _lanes(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """First tokens of each lane, on both sides: where texts begin, and places of long ones where tokens of both end."""
    begins_a, begins_b = np.cumsum(a.counts) - a.counts, np.cumsum(b.counts) - b.counts
    some = a.counts > 0
    more_a, more_b = [begins_a[some]], [begins_b[some]]
    for begin, count in zip(begins_a[some], a.counts[some]):
        if count < 2 * LANE:
            continue
        for at in range(begin + LANE, begin + count - LANE, LANE):
            ends = a.ends[at : at + AHEAD]
            place = np.searchsorted(b.ends, ends)
            shared = np.flatnonzero(b.ends[place] == ends)
            if len(shared):
                more_a.append(np.array([at + shared[0] + 1]))
                more_b.append(np.array([place[shared[0]] + 1]))
    # A place may be found twice, from two starting points.
    starts_a, kept = np.unique(np.concatenate(more_a), return_index=True)
    return starts_a, np.concatenate(more_b)[kept]


def lockstep(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (token of ``a``, token of ``b``) and cuts (tokens of both that end a group), as places in the joined rows.

    One pointer a side and lane. Each step links the two current tokens of
    every lane; the side whose token ends first moves on, both do where they
    end together, which is a cut. Lanes that are done leave the state.
    """
    i, j = _lanes(a, b)
    stop = np.append(i[1:], len(a.ids))
    none = np.empty(0, np.int64)
    links_a, links_b, cuts_a, cuts_b = [none], [none], [none], [none]
    while len(i):
        links_a.append(i)
        links_b.append(j)
        end_a, end_b = a.ends[i], b.ends[j]
        cut = end_a == end_b
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        i, j = i + (end_a <= end_b), j + (end_b <= end_a)
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    cuts_a, cuts_b = np.concatenate(cuts_a), np.concatenate(cuts_b)
    order = np.argsort(cuts_a, kind="stable")
    return np.concatenate(links_a), np.concatenate(links_b), cuts_a[order], cuts_b[order]


def _names(most: int) -> np.ndarray:
    """Numbers as text, one table for each mark that may follow; zero bytes fill up."""
    return np.array([[f"{n}{mark}".encode() for n in range(most)] for mark in ",|;"], _NAME)


@lru_cache(maxsize=1)
def _name_table(most: int) -> tuple[np.ndarray, np.ndarray]:
    names = _names(most)
    return names, np.char.str_len(names[0]).astype(np.int64)


def _group_texts(a: Tokens, b: Tokens, cuts_a: np.ndarray, cuts_b: np.ndarray, most: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text."""
    names, sizes = _name_table(most)
    before = lambda cuts, n: np.searchsorted(cuts, np.arange(n))
    group_a, group_b = before(cuts_a, len(a.ids)), before(cuts_b, len(b.ids))
    place_a = np.arange(len(a.ids)) + np.concatenate([[0], cuts_b + 1])[group_a]
    place_b = np.arange(len(b.ids)) + (cuts_a + 1)[group_b]
    mark_a, mark_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
    mark_a[cuts_a], mark_b[cuts_b] = 1, 2
    out = np.empty(len(a.ids) + len(b.ids), _NAME)
    size = np.empty(len(out), np.int64)
    out[place_a], out[place_b] = names[mark_a, a.ids], names[mark_b, b.ids]
    size[place_a], size[place_b] = sizes[a.ids], sizes[b.ids]
    raw = out.view(np.uint8)
    data = raw[raw != 0].tobytes()
    ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(a.counts + b.counts)]
    # Every text ends with the mark between groups, which is none at its end.
    return [data[s : e - 1] for s, e in zip(np.concatenate([[0], ends[:-1]]), ends)]


def _packed(doc: np.ndarray, pair: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Distinct (text, pair) and how often each occurs, compressed; and how many each text has."""
    key, times = np.unique((doc << np.int64(32)) | pair, return_counts=True)
    doc, pair = key >> np.int64(32), key & np.int64(0xFFFFFFFF)
    columns = np.concatenate([np.diff(pair, prepend=0), times]).astype("<i4")
    # Bytes of equal weight lie together, which compresses far better.
    return zlib.compress(columns.view(np.uint8).reshape(-1, 4).T.tobytes(), 1), doc


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    columns = np.ascontiguousarray(raw.T).view("<i4").ravel().astype(np.int64)
    deltas, times = np.split(columns, 2)
    return np.cumsum(deltas), times


_STATS = ["n_a", "n_b", "n_groups", "n_links", "distinct"]
_ALIGNED = (
    "batch string, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "n_links array<bigint>, distinct array<bigint>, groups_sha256 array<string>, pairs array<bigint>, times array<bigint>, links binary"
)


def _align(texts: list[str], first: str, second: str) -> dict[str, object]:
    """All columns but the ids of one batch of texts."""
    side_a, side_b = _sides(first, second)
    spaced = [f" {t}" if t else "" for t in texts]
    found_a, found_b = side_a.encode.encode(spaced), side_b.encode.encode(texts)
    for n, text in enumerate(spaced):
        raw = text.encode()
        if any(
            b"".join(map(side.written.__getitem__, found[n].tolist())) != raw
            for side, found in ((side_a, found_a), (side_b, found_b))
        ):
            found_a[n] = found_b[n] = np.empty(0, np.uint32)
    a, b = _tokens(found_a, side_a), _tokens(found_b, side_b)
    links_a, links_b, cuts_a, cuts_b = lockstep(a, b)
    doc_of_a = np.repeat(np.arange(len(texts)), a.counts)
    pairs, number, times = np.unique(
        a.ids[links_a] << np.int64(32) | b.ids[links_b], return_inverse=True, return_counts=True
    )
    packed, doc = _packed(doc_of_a[links_a], number)
    count = lambda docs: np.bincount(docs, minlength=len(texts))
    written = _group_texts(a, b, cuts_a, cuts_b, max(len(side_a.written), len(side_b.written)))
    return {
        "n_a": a.counts,
        "n_b": b.counts,
        "n_groups": count(doc_of_a[cuts_a]),
        "n_links": count(doc_of_a[links_a]),
        "distinct": count(doc),
        "groups_sha256": [hashlib.sha256(t).hexdigest() if n else "" for t, n in zip(written, a.counts)],
        "pairs": pairs,
        "times": times,
        "links": packed,
    }


def aligned_batches(docs: DataFrame, first: str, second: str, id_column: str = "doc_id") -> DataFrame:
    """One row per batch of texts: figures of each, the id pairs linked in the batch, and each text's links packed.

    ``pairs`` holds the distinct id pairs, the first tokenizer's id in the
    upper 32 bits, ``times`` how many links hold each. ``links`` refers to them by place.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("batch", pa.string()), ("doc_ids", pa.list_(pa.int64()))]
            + [(name, pa.list_(pa.int64())) for name in _STATS]
            + [("groups_sha256", pa.list_(pa.string())), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
            + [("links", pa.binary())]
        )
        held_ids: list = []
        held: list[str] = []
        size, number, part = 0, 0, None

        def batch_row() -> pa.RecordBatch:
            row = _align(held, first, second) | {"batch": f"{part}-{number}", "doc_ids": held_ids}
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

        for batch in batches:
            ids = iter(batch.column("doc_id").to_pylist())
            for group in in_groups((t.as_py() for t in batch.column("text")), CHARACTERS):
                part = batch.column("part")[0].as_py()
                held += group
                held_ids += [next(ids) for _ in group]
                size += sum(map(len, group))
                if size >= CHARACTERS:
                    yield batch_row()
                    held, held_ids, size, number = [], [], 0, number + 1
        if held:
            yield batch_row()

    texts = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), text_of().alias("text"), F.spark_partition_id().alias("part")
    )
    return texts.mapInArrow(align, _ALIGNED)


def pair_counts(batches: DataFrame) -> DataFrame:
    """``pair, links, best``: how many links hold each id pair, and whether none of its second id holds more."""
    each = batches.select(F.inline(F.arrays_zip("pairs", "times")))
    counted = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("links"))
    second: Column = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counted.groupBy(second.alias("second")).agg(F.max("links").alias("most"))
    return counted.join(most, second == F.col("second")).select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def aligned_tokens(docs: DataFrame, first: str, second: str, id_column: str = "doc_id") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each row of ``docs`` (``doc_id, text``).

    ``first`` is a byte-level file of the tokenizers library, ``second`` a
    SentencePiece file that puts a space before the text. Tokens are linked where their
    bytes overlap and cut into groups where both end. ``count_sum`` adds, over a
    text's links, how many links of all documents hold the same id pair; ``n_best``
    counts the links whose pair no other pair of its second id exceeds.

    Texts that are null or empty, or whose tokens do not spell a space and the
    text, have no tokens, zeros and an empty hash. Rows are independent:
    repeated rows and rows without an id each give a row and count each. Long
    texts are whole; a batch holds at least one text. An empty table gives an
    empty one, and columns other than the id and ``text`` are not read.
    """

    def finish(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        for rows_here in rows:
            for n in range(rows_here.num_rows):
                row = {name: rows_here.column(name)[n] for name in rows_here.schema.names}
                stats = {name: row[name].values.to_numpy() for name in _STATS}
                known = row["known"].values
                if known is None or not len(known):
                    sums = bests = np.zeros(len(stats["n_a"]), np.int64)
                else:
                    order = np.argsort(known.field("at").to_numpy())
                    links = known.field("links").to_numpy()[order]
                    best = known.field("best").to_numpy(zero_copy_only=False)[order]
                    pair, times = _unpacked(row["links"].as_py())
                    text = np.repeat(np.arange(len(stats["distinct"])), stats["distinct"])
                    sums = np.zeros(len(stats["distinct"]), np.int64)
                    bests = np.zeros_like(sums)
                    np.add.at(sums, text, links[pair] * times)
                    np.add.at(bests, text, best[pair] * times)
                columns = [row["doc_ids"].values, *(pa.array(stats[c]) for c in _STATS[:4])]
                columns += [pa.array(bests), pa.array(sums), row["groups_sha256"].values]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    spark = docs.sparkSession
    batches = stage(aligned_batches(docs, first, second, id_column))
    with shuffle_sized(spark, 4 * size_in_bytes(batches)):
        counts = stage(pair_counts(batches))
        each = batches.select("batch", F.posexplode("pairs").alias("at", "pair"))
        known = each.join(counts, "pair").groupBy("batch").agg(F.collect_list(F.struct("at", "links", "best")).alias("known"))
        joined = batches.drop("pairs", "times").join(known, "batch", "left")
    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return joined.mapInArrow(finish, schema)
