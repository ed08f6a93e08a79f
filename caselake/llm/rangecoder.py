"""Token ids as range-coded blocks, and files of them.

A block is coded on its own: its model starts empty and its checksum is kept
beside it. Predictions of order 2, 1 and 0 drive an arithmetic coder: first
whether the id that followed the last two comes again, with a chance mixed
from both higher orders, then the one that followed the last, then which of the
ids seen so far by their counts, or that it is a new one. All numbers are
integers. The blocks of a chunk are coded side by side, one numpy lane each.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.ordered import with_running_totals
from caselake.llm.rows import text_of
from caselake.llm.tokens import encoder, in_groups
from caselake.session import size_in_bytes, stage

BLOCK_IDS = 4096
# Blocks coded side by side; also how many ids a chunk of whole documents gathers.
LANES = 2048
# Ranges are coded by fewer tasks where these get less than this each, as the planner estimates it.
TASK_BYTES = 3 * 1024**2
# Chunks whose places are broadcast, some ten megabytes; beyond that they are joined by a shuffle.
MOST_BROADCAST = 400_000
MAGIC = b"IDS2"
_TOP, _BOTTOM, _BYTE, _THREE = np.uint32(1 << 24), np.uint32(1 << 16), np.uint32(1 << 8), np.uint32(3)
# Slots of a lane lie in groups of this many, and groups in groups.
GROUP = 16
# Contexts of order 2 in a lane; how sure a guess can be; probabilities have 16 bits, of which 12 are coded.
_CONTEXTS, _SUREST, _SHIFT, _RATE = 4096, 3, 5, 14
_SCALE, _LENGTHS, _GAIN = 4096, 33, 4
_LENGTHS_HELD = -(-_LENGTHS // 8) * 8
_EACH, _LAST = np.uint64(0x0001000100010001), np.uint64(48)


def _squash(x: float) -> int:
    return min(_SCALE - 1, max(1, round(_SCALE / (1 + math.exp(-x / 256)))))


_SQUASH = np.array([_squash(x) for x in range(-2047, 2048)], np.int64)
_STRETCH = np.searchsorted(_SQUASH, np.arange(_SCALE)).clip(0, 4094) - 2047
# For the first 12 bits of a probability: the place on the scale that is mixed of the one that is coded.
_STRETCHED = _STRETCH[np.arange(_SCALE).clip(1)]
# What a new id of a length adds to the running counts of lengths.
_LONGER = np.triu(np.full((_LENGTHS, _LENGTHS_HELD), _GAIN, np.uint16))


class _Model:
    """What the ids of a lane so far let expect.

    An id gets a slot when it first occurs. Order 0 counts each slot, each
    group of slots, and in running sums each group of groups. Orders 1 and 2 hold for
    each context the slot that followed and how sure it is. Whether the guess
    of order 2 holds is a probability mixed from what both orders say, by
    weights that are learned in the lane; the one of order 1 alone has its own.

    Every step looks at all lanes at once and masks those that are not asked:
    picking them out and putting them back takes longer than the sums.
    """

    def __init__(self, steps: int, nothing: np.ndarray) -> None:
        lanes = len(nothing)
        over = -(-max(steps, nothing.max()) // GROUP**2)
        slots = over * GROUP**2
        lane = np.arange(lanes)
        self.lane_slots, self.lane_pairs = lane * (slots + 1), lane * _CONTEXTS
        # Groups of groups: running counts, and what each adds to them.
        width = -(-over // 8) * 8
        self.sums = np.zeros((lanes, width), np.uint16)
        self.added = np.triu(np.ones((width, width), np.uint16), 1)
        # Counts of groups and of slots: where a lane's begin, and what a place has of a slot's bits.
        self.bases, self.shifts = (lane * over * GROUP, lane * slots), (4, 0)
        self.counts = [np.zeros(lanes * n, np.uint16) for n in (over * GROUP, slots)]
        self.known = np.zeros(lanes, np.int64)
        # Guess and sureness of each context in one number.
        self.guess = [np.zeros(size, np.uint16) for size in (lanes * (slots + 1), lanes * _CONTEXTS)]
        self.last = nothing, nothing
        # Chances: order 2 by its sureness, order 1 by agreement and sureness, order 1 alone, a new id.
        self.lane_two, self.lane_four, self.lane_eight = lane * 2, lane * (_SUREST + 1), lane * 2 * (_SUREST + 1)
        sizes = lanes * (_SUREST + 1), lanes * 2 * (_SUREST + 1), lanes * (_SUREST + 1), lanes * 2
        self.by_two, self.by_one, self.alone, self.new = (np.full(size, 1 << 15, np.int64) for size in sizes)
        self.weights = [np.full(lanes * 2, 40_000, np.int64) for _ in range(2)]
        # Running counts of the lengths of new ids, each with its own included; padded to whole words.
        self.lengths = np.tile(np.arange(1, _LENGTHS_HELD + 1, dtype=np.uint16).clip(max=_LENGTHS), (lanes, 1))

    def expect(self) -> None:
        one, two = self.last
        pair = (one * 0x9E3779B1 + two * 0x85EBCA6B >> 7) & (_CONTEXTS - 1)
        self.at = self.lane_slots + one, self.lane_pairs + pair
        self.held = [guess.take(at).astype(np.int64) for guess, at in zip(self.guess, self.at)]
        self.guessed = [x >> 2 for x in self.held]
        self.sureness = [x & _SUREST for x in self.held]
        self.asked = [x > 0 for x in self.sureness]
        self.same = self.guessed[0] == self.guessed[1]

    def mixed(self) -> np.ndarray:
        """The chance that the guess of order 2 holds."""
        agree = self.same & self.asked[0]
        self.cells = self.lane_four + self.sureness[1], self.lane_eight + (agree * np.int64(_SUREST + 1) + self.sureness[0])
        self.weighed = self.lane_two + agree
        self.chances = [chances.take(cell) for chances, cell in zip((self.by_two, self.by_one), self.cells)]
        self.inputs = [_STRETCHED.take(p >> 4) for p in self.chances]
        self.weight = [weights.take(self.weighed) for weights in self.weights]
        dot = self.weight[0] * self.inputs[0] + self.weight[1] * self.inputs[1] >> 16
        self.chance = _SQUASH.take(dot + 2047, mode="clip")
        return self.chance

    def learn_mix(self, asked: np.ndarray, held: np.ndarray) -> None:
        error = ((held.astype(np.int64) << 12) - self.chance) * (asked * np.int64(_RATE))
        for weights, weight, x in zip(self.weights, self.weight, self.inputs):
            weights[self.weighed] = weight + (x * error >> 14)
        for chances, cell, p in zip((self.by_two, self.by_one), self.cells, self.chances):
            _moved(chances, cell, p, asked, held)

    def start(self, lanes: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids of slots below ``slot`` occurred, and how many of that."""
        start = self.sums[lanes, slot >> 8]
        for base, counts, shift in zip(self.bases, self.counts, self.shifts):
            at = base[lanes] + (slot >> shift)
            size = counts[at]
            start = start + (_running(counts, at >> 4).ravel()[_in_rows(at & (GROUP - 1))] - size)
        return start, size

    def find(self, lanes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The slot whose interval holds ``place``, where it starts and its size."""
        place = place.astype(np.uint16)
        slot = _ones(self.sums[lanes] <= place[:, None]) - 1
        left = place - self.sums[lanes, slot]
        for base, counts in zip(self.bases, self.counts):
            row = (base[lanes] >> 4) + slot
            ends = _running(counts, row)
            at = np.minimum(_ones(ends <= left[:, None]), GROUP - 1)
            slot, size = slot * GROUP + at, counts[row * GROUP + at]
            left = left - (ends.ravel()[_in_rows(at)] - size)
        # Slots that are not taken yet have empty intervals after the last one.
        return slot, place - left, size

    def learn(self, slot: np.ndarray) -> None:
        self.sums += self.added.take(slot >> 8, axis=0)
        for base, counts, shift in zip(self.bases, self.counts, self.shifts):
            at = base + (slot >> shift)
            counts[at] = counts[at] + np.uint16(1)
        fresh = slot * 4 + 1
        for guess, at, held, guessed, sureness, asked in zip(
            self.guess, self.at, self.held, self.guessed, self.sureness, self.asked
        ):
            right = (guessed == slot) & asked
            wrong = np.where(sureness > 1, held - 1, fresh)
            guess[at] = np.where(right, held + (sureness < _SUREST), wrong).astype(np.uint16)
        self.last = slot, self.last[0]


def _in_rows(place: np.ndarray) -> np.ndarray:
    return np.arange(len(place)) * GROUP + place


def _running(counts: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each of the groups ``row``, the running sums of its counts, each with its own included."""
    words = counts.view(np.uint64).reshape(-1, GROUP // 4).take(row, axis=0)
    # Four counts of 16 bits at a time; sums stay below 2**16, so none runs over into its neighbour.
    words *= _EACH
    before = words[:, 0] >> _LAST
    for i in range(1, GROUP // 4):
        words[:, i] += before * _EACH
        before = words[:, i] >> _LAST
    return words.view(np.uint16)


def _ones(flags: np.ndarray) -> np.ndarray:
    """How many of each row are true; a row has a multiple of 8."""
    words = np.bitwise_count(flags.view(np.uint64))
    ones = words[:, 0]
    for i in range(1, words.shape[1]):
        ones = ones + words[:, i]
    return ones.astype(np.int64)


def _moved(chances: np.ndarray, cell: np.ndarray, p: np.ndarray, asked: np.ndarray, held: np.ndarray) -> None:
    """Chances ``p`` of ``cell`` go towards what was ``held``, where ``asked``."""
    chances[cell] = p + (held * np.int64(0xFFFF) - p >> _SHIFT) * asked


class _Coder:
    def __init__(self, lanes: int) -> None:
        self.low = np.zeros(lanes, np.uint32)
        self.range = np.full(lanes, 0xFFFFFFFF, np.uint32)

    def chosen(self, asked: np.ndarray, chance: np.ndarray, truth: np.ndarray | None) -> np.ndarray:
        """Code, or read, a yes or no for the lanes that are ``asked``."""
        part = self.range >> np.uint32(12)
        bound = part * chance.astype(np.uint32)
        held = asked & (self.below(bound) if truth is None else truth)
        self.low = self.low + bound * (asked ^ held)
        self.range = np.where(asked, np.where(held, bound, (part << np.uint32(12)) - bound), self.range)
        self._settle()
        return held

    def narrow(self, lanes: np.ndarray, part: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Go on in ``size`` parts from part ``start`` on; :meth:`_settle` has to follow."""
        self.low[lanes] = self.low.take(lanes) + start * part
        self.range[lanes] = size * part

    def _settle(self) -> None:
        """Give, or take, the bytes that are settled."""
        low, span = self.low, self.range
        differ = low ^ (low + span)
        many = (differ < _TOP).view(np.uint8) + (differ < _BOTTOM).view(np.uint8) + (differ < _BYTE).view(np.uint8)
        bits = many.astype(np.uint32) << _THREE
        self._shift(low, many, bits)
        self.low, self.range = low << bits, span << bits
        tight = (self.range < _BOTTOM).nonzero()[0]
        while len(tight):
            # Too little is left on both sides of a border: the rest up to it is taken.
            low, span = self.low[tight], self.range[tight]
            settled = (low ^ (low + span)) < _TOP
            span = np.where(settled, span, (~low + np.uint32(1)) & (_BOTTOM - np.uint32(1)))
            self._shift_some(tight, low)
            low, span = low << np.uint32(8), span << np.uint32(8)
            self.low[tight], self.range[tight] = low, span
            tight = tight[((low ^ (low + span)) < _TOP) | (span < _BOTTOM)]


class _Writer(_Coder):
    def __init__(self, lanes: int, most: int) -> None:
        super().__init__(lanes)
        self.out = np.zeros((lanes, most), np.uint8)
        self.flat, self.base = self.out.ravel(), np.arange(lanes) * most
        self.at = self.base.copy()

    def _shift(self, low: np.ndarray, many: np.ndarray, bits: np.ndarray) -> None:
        for i in range(3):
            some = (many > i).nonzero()[0]
            if not len(some):
                break
            self.flat[self.at[some] + i] = (low[some] >> np.uint32(24 - 8 * i)).astype(np.uint8)
        self.at += many

    def _shift_some(self, lanes: np.ndarray, low: np.ndarray) -> None:
        at = self.at[lanes]
        self.flat[at] = (low >> np.uint32(24)).astype(np.uint8)
        self.at[lanes] = at + 1

    def finish(self) -> list[bytes]:
        every = np.arange(len(self.low))
        for _ in range(4):
            self._shift_some(every, self.low)
            self.low = self.low << np.uint32(8)
        return [row[:n].tobytes() for row, n in zip(self.out, self.at - self.base)]


class _Reader(_Coder):
    def __init__(self, coded: list[bytes]) -> None:
        super().__init__(len(coded))
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        data = np.frombuffer(b"".join(coded) + bytes(16), np.uint8).astype(np.uint32)
        # At each place, four bytes as a number.
        self.data = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
        start = np.cumsum(sizes) - sizes
        self.code, self.at = self.data.take(start), start + 4

    def _shift(self, low: np.ndarray, many: np.ndarray, bits: np.ndarray) -> None:
        # Two shifts, as none is by a whole number's width.
        more = self.data.take(self.at, mode="clip") >> np.uint32(8) >> (np.uint32(24) - bits)
        self.code, self.at = self.code << bits | more, self.at + many

    def _shift_some(self, lanes: np.ndarray, low: np.ndarray) -> None:
        at = self.at[lanes]
        self.code[lanes] = self.code[lanes] << np.uint32(8) | self.data.take(at, mode="clip") >> np.uint32(24)
        self.at[lanes] = at + 1

    def below(self, bound: np.ndarray) -> np.ndarray:
        return self.code - self.low < bound

    def peek(self, lanes: np.ndarray, part: np.ndarray, total) -> np.ndarray:
        return np.minimum((self.code.take(lanes) - self.low.take(lanes)) // part, total - np.uint32(1))


def _new_lengths(coder: _Coder, model: _Model, lanes: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
    """Code, or read, the lengths in bits of ids that are new in their lane, by the lane's counts of them."""
    ends = model.lengths.take(lanes, axis=0)
    total = ends[:, -1].astype(np.uint32)
    part = coder.range.take(lanes) // total
    if ids is None:
        length = _ones(ends <= coder.peek(lanes, part, total).astype(np.uint16)[:, None])
    else:
        length = np.frexp(ids.astype(np.float64))[1].astype(np.int64)
    at = np.arange(len(lanes)) * _LENGTHS_HELD + length
    start = np.where(length > 0, ends.take(at - 1, mode="clip"), np.uint16(0)).astype(np.uint32)
    coder.narrow(lanes, part, start, ends.take(at) - start)
    model.lengths[lanes] = ends + _LONGER.take(length, axis=0)
    return length


def _new_bits(coder: _Coder, lanes: np.ndarray, length: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
    """Code, or read, the bits of ids of a length."""
    # The highest bit is known; at most 16 of the others are coded at a time.
    value = (length > 0).astype(np.int64)
    left = np.maximum(length - 1, 0)
    while left.any():
        some = left.nonzero()[0]
        here = lanes[some]
        bits = np.minimum(left[some], 16)
        left[some] -= bits
        width = np.int64(1) << bits
        part = coder.range.take(here) >> bits.astype(np.uint32)
        if ids is None:
            found = coder.peek(here, part, width.astype(np.uint32))
        else:
            found = ((ids[some].astype(np.int64) >> left[some]) & (width - 1)).astype(np.uint32)
        coder.narrow(here, part, found, np.uint32(1))
        coder._settle()
        value[some] = (value[some] << bits) | found
    return value.astype(np.uint32)


def _run(coder: _Coder, sizes: np.ndarray, nothing: np.ndarray, slots: np.ndarray | None, ids: np.ndarray | None) -> np.ndarray:
    """Code ``ids`` (a row per step, a column per lane), or read them.

    ``slots`` are theirs, a lane has as many as its size; ``nothing`` stands for the ids before its first one.
    """
    lanes, steps, least = len(sizes), int(sizes.max()), int(sizes.min())
    model, told = _Model(steps, nothing), slots is not None
    found = np.zeros((steps, lanes), np.uint16)
    id_of = None if told else np.zeros((lanes, steps), np.uint32)
    every = np.ones(lanes, bool)
    truth = None
    for step in range(steps):
        open_ = every if step < least else step < sizes
        model.expect()
        slot = slots[step].astype(np.int64) if told else np.zeros(lanes, np.int64)

        asked = open_ & model.asked[1]
        if told:
            truth = slot == model.guessed[1]
        held = coder.chosen(asked, model.mixed(), truth)
        model.learn_mix(asked, held)
        if not told:
            slot = np.where(held, model.guessed[1], slot)
        open_ = open_ & ~held

        asked = open_ & model.asked[0] & ~(model.same & model.asked[1])
        cell = model.lane_four + model.sureness[0]
        p = model.alone.take(cell)
        if told:
            truth = slot == model.guessed[0]
        held = coder.chosen(asked, np.maximum(p >> 4, 1), truth)
        _moved(model.alone, cell, p, asked, held)
        if not told:
            slot = np.where(held, model.guessed[0], slot)
        open_ = open_ & ~held

        cell = model.lane_two + model.asked[0]
        p = model.new.take(cell)
        if step:
            fresh = coder.chosen(open_, np.maximum(p >> 4, 1), slot == model.known if told else None)
        else:
            # The first id of a lane is new without saying so.
            fresh = open_
        _moved(model.new, cell, p, open_, fresh)

        old = (open_ ^ fresh).nonzero()[0]
        if len(old):
            # As many ids came before as there were steps.
            part = coder.range.take(old) // np.uint32(step)
            if told:
                start, size = model.start(old, slot[old])
            else:
                slot[old], start, size = model.find(old, coder.peek(old, part, np.uint32(step)))
            coder.narrow(old, part, start.astype(np.uint32), size.astype(np.uint32))
        new = fresh.nonzero()[0]
        if len(new):
            values = ids[step].take(new) if told else None
            length = _new_lengths(coder, model, new, values)
        coder._settle()
        if len(new):
            values = _new_bits(coder, new, length, values)
            if not told:
                at = model.known.take(new)
                slot[new] = at
                id_of.ravel()[new * steps + at] = values
            model.known += fresh
        if not told:
            found[step] = slot
        model.learn(slot)
    if told:
        return ids
    found[np.arange(steps)[:, None] >= sizes] = 0
    return np.take_along_axis(id_of, found.T.astype(np.int64), 1)


def _slots(blocks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each id of the ``blocks`` (a row each) its slot: how many other ids occurred first before it did."""
    lanes, steps = blocks.shape
    out = np.empty((lanes, steps), np.uint16)
    for first in range(0, lanes, 64):
        some = blocks[first : first + 64]
        # Equal ids lie beside each other, the earliest first; what follows a block comes last.
        key = some.astype(np.int64) << 16 | np.arange(steps)
        key[np.arange(steps) >= sizes[first : first + 64, None]] |= 1 << 60
        key.sort(axis=1)
        place = (key & 0xFFFF) + np.arange(len(some))[:, None] * steps
        begins = np.ones(key.shape, bool)
        begins[:, 1:] = key[:, 1:] >> 16 != key[:, :-1] >> 16
        is_first = np.zeros(key.size, bool)
        earliest = place[begins]
        is_first[earliest] = True
        slot = (np.cumsum(is_first.reshape(key.shape), axis=1, dtype=np.uint16) - np.uint16(1)).ravel().take(earliest)
        out[first : first + 64].ravel()[place.ravel()] = slot.take(np.cumsum(begins.ravel()) - 1)
    return out


def _before(sizes: list[int]) -> list[int]:
    """What stands for the ids before each block of a chunk, by the first of the blocks that are coded together in it."""
    return [-(-sizes[i - i % LANES] // GROUP**2) * GROUP**2 for i in range(len(sizes))]


def _encode_lanes(blocks: list[np.ndarray], nothing: np.ndarray) -> list[bytes]:
    sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
    full = np.zeros((len(blocks), sizes.max()), np.uint32)
    for row, block in zip(full, blocks):
        row[: len(block)] = block
    out = _Writer(len(blocks), 64 + full.shape[1] * 9)
    _run(out, sizes, nothing, np.ascontiguousarray(_slots(full, sizes).T), np.ascontiguousarray(full.T))
    return out.finish()


def _decode_lanes(coded: list[bytes], sizes: np.ndarray, nothing: np.ndarray) -> np.ndarray:
    """The ids of each block in a row."""
    return _run(_Reader(coded), sizes, nothing, None, None)


def encode_each(chunks: list[np.ndarray]) -> list[bytes]:
    """Each of ``chunks`` as :func:`encode_ids` has it; the blocks of all are coded side by side."""
    cut = [[ids[at : at + BLOCK_IDS] for at in range(0, len(ids), BLOCK_IDS)] for ids in (np.asarray(x, np.uint32) for x in chunks)]
    blocks = [block for some in cut for block in some]
    nothing = np.array([x for some in cut for x in _before([len(block) for block in some])], np.int64)
    coded = (x for at in range(0, len(blocks), LANES) for x in _encode_lanes(blocks[at : at + LANES], nothing[at : at + LANES]))
    found = []
    for some in cut:
        out = [MAGIC, struct.pack("<QI", sum(map(len, some)), BLOCK_IDS)]
        for block, data in zip(some, coded):
            out.append(struct.pack("<II", len(data), zlib.crc32(block.astype("<u4").tobytes())) + data)
        found.append(b"".join(out))
    return found


def encode_ids(ids: np.ndarray) -> bytes:
    """``ids`` (unsigned 32-bit) as one chunk: a header, then a head and the bytes of each block."""
    return encode_each([ids])[0]


def decode_each(chunks: list[bytes]) -> list[np.ndarray]:
    """The ids of each chunk; a block whose checksum differs is an error that names it."""
    coded, sums, sizes, nothing, counts = [], [], [], [], []
    for chunk in chunks:
        if chunk[:4] != MAGIC:
            raise ValueError("not a chunk of token ids")
        total, size = struct.unpack_from("<QI", chunk, 4)
        at, held = 16, [min(size, total - start) for start in range(0, total, size)]
        for block in range(len(held)):
            n, crc = struct.unpack_from("<II", chunk, at)
            coded.append(chunk[at + 8 : at + 8 + n])
            sums.append((block, crc))
            at += 8 + n
        sizes += held
        nothing += _before(held)
        counts.append(len(held))
    blocks: list[np.ndarray] = []
    for at in range(0, len(coded), LANES):
        some, before = (np.array(x[at : at + LANES], np.int64) for x in (sizes, nothing))
        blocks.extend(row[:n] for row, n in zip(_decode_lanes(coded[at : at + LANES], some, before), some))
    for (i, crc), ids in zip(sums, blocks):
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError(f"block {i} of a chunk of token ids is damaged")
    every = iter(blocks)
    return [np.concatenate([np.empty(0, np.uint32), *islice(every, n)]) for n in counts]


def decode_ids(chunk: bytes) -> np.ndarray:
    """The ids of a chunk; a block whose checksum differs is an error that names it."""
    return decode_each([chunk])[0]


def _together(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of chunks of these sizes that fill the lanes together; a larger chunk is one by itself."""
    start = held = 0
    for end, size in enumerate(sizes):
        if held and held + size > BLOCK_IDS * LANES:
            yield start, end
            start, held = end, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """The ids of ``docs`` (``doc_id, text``) as files of coded chunks below ``path``, in ascending order of id.

    A row of a file is a chunk of whole documents of one range: ``part`` and ``chunk``
    number it, ``doc_ids`` and ``n_tokens`` list its documents, ``coded`` holds
    their ids. Parquet carries the rows, so any store that Spark writes will do.

    Null text is empty: the end id only. Rows without an id come first,
    repeated ids stay beside each other. An empty table gives no chunk. A
    document is in one chunk, however long, so a worker's memory has to hold its ids.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        # Chunks that are whole, and the documents and ids of the one that is not; the part and number of each.
        whole: list[tuple[int, int, list, list[np.ndarray]]] = []
        doc_ids: list = []
        held: list[np.ndarray] = []
        size, part, number = 0, None, 0

        def close() -> None:
            nonlocal doc_ids, held, number
            if held:
                whole.append((part, number, doc_ids, held))
                doc_ids, held, number = [], [], number + 1

        def chunks() -> pa.RecordBatch:
            coded = encode_each([np.concatenate(ids) for *_, ids in whole])
            rows = [(p, n, of, [len(x) for x in ids], data) for (p, n, of, ids), data in zip(whole, coded)]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            places = zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist())
            for group in in_groups(batch.column("text").to_pylist()):
                for found in encode(group):
                    here, doc_id = next(places)
                    if here != part:
                        close()
                        part, number = here, 0
                    doc_ids.append(doc_id)
                    held.append(np.append(found, np.uint32(end_id)))
                    size += len(held[-1])
                    if size >= BLOCK_IDS * LANES:
                        close()
                        yield chunks()
                        whole, size = [], 0
        close()
        if whole:
            yield chunks()

    names = ["part", "chunk", "doc_ids", "n_tokens", "coded"]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    ranged = texts.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first()
    )
    numbered = ranged.withColumn("part", F.spark_partition_id().cast("bigint"))
    # A step takes as long for a few blocks as for many, so a task goes through several small ranges.
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size_in_bytes(texts) // TASK_BYTES))
    numbered = numbered.coalesce(min(parts, tasks))
    schema = "part bigint, chunk bigint, doc_ids array<bigint>, n_tokens array<bigint>, coded binary"
    numbered.mapInArrow(code, schema).write.parquet(path)


def read_ids(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document below ``path``, decoded from the coded ids.

    ``start`` counts the ids of all documents before. ``keep_ids`` adds the
    ``ids`` themselves, as little-endian unsigned 32-bit integers.
    """

    def open_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [x.values.to_numpy() for x in batch.column("n_tokens")]
            for start, end in _together([int(x.sum()) for x in sizes]):
                chunks = batch.slice(start, end - start)
                for row, data in enumerate(decode_each(chunks.column("coded").to_pylist())):
                    yield documents(chunks.slice(row, 1), sizes[start + row], data.astype("<u4"))

    def documents(chunk: pa.RecordBatch, sizes: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
        if sizes.sum() != len(data):
            raise ValueError("a chunk of token ids does not match its list of documents")
        ends = np.cumsum(sizes)
        cut = [data[e - n : e].tobytes() for e, n in zip(ends, sizes)]
        first = chunk.column("first")[0].as_py()
        columns = [chunk.column("doc_ids").flatten(), pa.array(first + ends - sizes), pa.array(sizes)]
        columns.append(pa.array([zlib.crc32(x) for x in cut], pa.int64()))
        if keep_ids:
            columns.append(pa.array(cut, pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    chunks = spark.read.parquet(path)
    total = F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, n: a + n)
    firsts = with_running_totals(chunks.select("part", "chunk", "n_tokens"), ["part", "chunk"], first=total)
    firsts = stage(firsts.select("part", "chunk", "first"))
    # A row of 24 bytes for some four million ids; the coded bytes are not shuffled for them.
    few = firsts.count() <= MOST_BROADCAST
    found = chunks.join(F.broadcast(firsts) if few else firsts, ["part", "chunk"])
    return found.select("doc_ids", "n_tokens", "coded", "first").mapInArrow(open_chunks, schema)
