"""Packing tokenized documents into windows of one size by non-negative least squares."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.llm.ordered import with_running_totals
from caselake.llm.rows import text_of
from caselake.llm.tokens import encoder, in_groups
from caselake.session import stage

WINDOW = 4096
# Steps of the projected gradient; the rounding after it makes up for what they leave.
STEPS = 150


@dataclass(frozen=True)
class Plan:
    """Where the remainders go, in order of length: each slice of the order fills one place of one pattern.

    Slice ``i`` starts at ``starts[i]`` in that order. Its member ``j`` lies in
    sequence ``sequence[i] + j // each[i]``, at ``offset[i] + j % each[i] * length[i]``.
    """

    starts: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    sequences: int


def patterns(counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Combinations of up to three lengths that fill the window exactly: lengths and how often each, 0 for none.

    The first length may repeat, the others close the gap: one more document,
    or two that split the gap at a few fixed shares.
    """
    present = counts > 0
    first = np.nonzero(present)[0]
    times = window // first
    a = np.repeat(first, times)
    k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + 1
    usable = k <= counts[a]
    a, k = a[usable], k[usable]
    gap = window - a * k
    zero = np.zeros_like(a)
    found = [np.stack([a, zero, zero, k, zero, zero], 1)[gap == 0]]
    one = (gap > 0) & present[gap]
    found.append(np.stack([a, gap, zero, k, np.ones_like(a), zero], 1)[one])
    for share in (2, 3, 5, 8):
        b = gap // share
        c = gap - b
        two = (b > 0) & present[b] & present[c]
        found.append(np.stack([a, b, c, k, np.ones_like(a), np.ones_like(a)], 1)[two])
    every = np.concatenate(found)
    return every[:, :3], every[:, 3:]


def solve(lengths: np.ndarray, times: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-negative repeat counts that come nearest to using up ``counts``, by accelerated projected gradient."""
    size = np.sqrt((times.astype(float) ** 2).sum(1))
    weight = times / size[:, None]

    def used(x: np.ndarray) -> np.ndarray:
        return np.bincount(lengths.ravel(), (weight * x[:, None]).ravel(), len(counts))

    def pull(r: np.ndarray) -> np.ndarray:
        return (weight * r[lengths]).sum(1)

    probe = np.ones(len(size))
    for _ in range(12):
        probe = pull(used(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    target = counts.astype(float)
    target[0] = 0
    x = y = np.zeros(len(size))
    momentum = 1.0
    for _ in range(STEPS):
        moved = np.maximum(0, y - pull(used(y) - target) / (1.05 * norm))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = moved + (momentum - 1) / following * (moved - x)
        x, momentum = moved, following
    return x / size


def plan(counts: np.ndarray, window: int = WINDOW) -> Plan:
    """A plan for ``counts[n]`` remainders of length ``n``; its size depends on the window only.

    Rounded solutions are taken as far as the documents last, then any exact
    pattern that still fits. What remains is packed greedily, longest first.
    """
    rest = counts.astype(np.int64).copy()
    rest[0] = 0
    slices: dict[int, list[tuple[int, int, int, int]]] = {}
    sequences = 0

    def take(lengths: list[int], times: list[int], repeat: int) -> None:
        nonlocal sequences
        offset = 0
        for n, k in zip(lengths, times):
            slices.setdefault(n, []).append((repeat * k, sequences, k, offset))
            rest[n] -= repeat * k
            offset += n * k
        sequences += repeat

    if rest.any():
        lengths, times = patterns(rest, window)
        if len(lengths):
            wanted = np.rint(solve(lengths, times, rest)).astype(np.int64)
            for limit in (wanted, None):
                order = np.argsort(-wanted, kind="stable")
                for i in order if limit is None else order[wanted[order] > 0]:
                    merged: dict[int, int] = {}
                    for n, k in zip(lengths[i].tolist(), times[i].tolist()):
                        if k:
                            merged[n] = merged.get(n, 0) + k
                    repeat = min(int(rest[n]) // k for n, k in merged.items())
                    repeat = repeat if limit is None else min(repeat, int(limit[i]))
                    if repeat > 0:
                        take(list(merged), list(merged.values()), repeat)
    while rest.any():
        room, chosen, left = window, {}, rest.copy()
        while room > 0:
            fitting = np.nonzero(left[: room + 1])[0]
            if not len(fitting):
                break
            n = int(fitting[-1])
            k = min(int(left[n]), room // n)
            chosen[n] = k
            left[n] = 0
            room -= n * k
        take(list(chosen), list(chosen.values()), min(int(rest[n]) // k for n, k in chosen.items()))

    rows = [(n, *s) for n in sorted(slices) for s in slices[n]]
    length, members, sequence, each, offset = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.empty(0, np.int64)] * 5
    return Plan(np.cumsum(members) - members, sequence, each, offset, length, sequences)


def _measured(docs: DataFrame, path: str, end_id: int, window: int, keep_ids: bool) -> DataFrame:
    """Per row its token count, the checksum of each of its pieces and, if asked for, the ids."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            sizes, sums, kept = [], [], []
            for group in in_groups(batch.column(2).to_pylist()):
                for ids in encode(group):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    sizes.append(len(ids))
                    sums.append([zlib.crc32(ids[i : i + window].tobytes()) for i in range(0, len(ids), window)])
                    kept.append(ids.tobytes() if keep_ids else None)
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64())]
            columns += [pa.array(sums, pa.list_(pa.int64())), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n", "sums", "ids"])

    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_of().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(measure, f"row bigint, doc_id {kind}, n bigint, sums array<bigint>, ids binary")


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, keep_ids: bool = False
) -> DataFrame:
    """The pieces of ``docs`` (``doc_id, text``) and their places in sequences of at most ``window`` ids.

    A document is its ids and ``end_id``. Only documents longer than the window
    are cut, at its multiples: full pieces are sequences of their own. The
    remainders are counted by length. That histogram has fewer entries than
    the window has ids, so the driver can plan from it for any number of
    documents: combinations of up to three lengths that fill the window, their
    repeat counts by non-negative least squares, rounded, and the residue
    packed greedily. A document finds its place from its number in the order
    by length, which running sums over ranges give.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` and with ``keep_ids`` the little-endian unsigned 32-bit ``ids``
    of each piece. Null text is empty and has the end id only. Repeated rows
    are packed each, ids may be null, and an empty table gives no pieces.
    Other columns are not passed on. A text is encoded whole, however long, so
    a worker's memory has to hold its ids.
    """
    whole = F.floor(F.col("n") / window)
    rest = F.col("n") % window
    # Written first: the order by length draws a sample, which would tokenize everything once more.
    measured = stage(_measured(docs, tokenizer, end_id, window, keep_ids)).withColumn("rest", rest)
    placed = with_running_totals(
        measured, ["rest", "row"], place=(F.col("rest") > 0).cast("bigint"), full_before=whole.cast("bigint")
    )
    counts = np.zeros(window, np.int64)
    for row in placed.groupBy("rest").count().collect():  # at most one row per length below the window
        counts[row["rest"]] = row["count"]
    known = docs.sparkSession.sparkContext.broadcast(plan(counts, window))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = known.value
        for batch in batches:
            n = batch.column("n").to_numpy()
            place, before = batch.column("place").to_numpy(), batch.column("full_before").to_numpy()
            full, rest = n // window, n % window
            each = full + (rest > 0)
            row = np.repeat(np.arange(len(n)), each)
            nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            is_full = nth < full[row]
            length = np.where(is_full, window, rest[row])
            sequence = p.sequences + before[row] + nth
            offset = np.zeros(len(row), np.int64)
            part = ~is_full
            own = place[row[part]]
            at = np.searchsorted(p.starts, own, side="right") - 1
            member = own - p.starts[at]
            sequence[part] = p.sequence[at] + member // p.each[at]
            offset[part] = p.offset[at] + member % p.each[at] * p.length[at]
            sums = batch.column("sums").flatten()
            columns = [batch.column("doc_id").take(pa.array(row)), pa.array(nth * window), pa.array(length), sums]
            columns += [pa.array(n[row]), pa.array(sequence), pa.array(offset)]
            if keep_ids:
                ids = batch.column("ids").to_pylist()
                columns.append(
                    pa.array([ids[r][4 * i * window : 4 * (i + 1) * window] for r, i in zip(row, nth)], pa.binary())
                )
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * keep_ids
    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in names[1:7]) + ", ids binary" * keep_ids
    return placed.select("doc_id", "n", "sums", "ids", "place", "full_before").mapInArrow(pieces, schema)
