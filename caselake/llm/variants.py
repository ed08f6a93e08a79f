"""Spelling variants: words one insertion, deletion or replacement apart, found with bit-sliced position indexes."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.llm.rows import text_of
from caselake.session import shuffle_sized, size_in_bytes, stage

_RUN = re.compile("[a-zÀ-ÿ]+")
# Distinct words that a task counts before it hands them on.
MOST_COUNTED = 300_000
# One word in so many loses a letter, by a checksum of its document and itself.
EDITED = 97
# A word is cut in so many pieces; one edit leaves all but one of them as they are.
PIECES = 3
# Words of a block that one group indexes; larger blocks go in pairs of such chunks.
CHUNK = 4096
# Words that ask are compared with 64 indexed words at a time: so many comparisons side by side, with so many
# columns of 64 words in an index, and so many letters by position in one.
SIDE_BY_SIDE, COLUMNS, CELLS = 1 << 16, 1 << 10, 1 << 15


def damaged(doc_id: int | None, run: str) -> str:
    """``run`` without one code point, for one pair of document and run in ``EDITED``."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % EDITED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, shortest: int = 5, fewest: int = 3, id_column: str = "doc_id") -> DataFrame:
    """``word, n``: how often each word of at least ``shortest`` code points occurs, if at least ``fewest`` times.

    Counted over all documents and whole texts; tasks add up a bounded number
    of distinct words before anything is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # The lower case of bytes is that of A-Z alone.
                runs = Counter(_RUN.findall(text.as_py().encode().lower().decode()))
                for run, n in runs.items():
                    word = damaged(doc_id, run)
                    if len(word) >= shortest:
                        total[word] += n
                if len(total) >= MOST_COUNTED:
                    yield _counts(total)
                    total.clear()
        yield _counts(total)

    texts = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), text_of().alias("text"))
    counted = texts.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


def _counts(total: Counter[str]) -> pa.RecordBatch:
    columns = [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def blocks(words: DataFrame) -> DataFrame:
    """``key, gap, last, start, asks, word, n``: each word once for every piece that an edit may change.

    Words of a size ask, words of that size and of one letter more answer. Two
    words one edit apart agree in all pieces of the shorter one but that of
    the edit, so they share the key that leaves out this piece. ``gap`` is its
    size in the shorter word, ``start`` where it begins.
    """
    length = F.char_length("word")

    def cut(longer: int, i: int) -> Column:
        size = length - longer
        start, end = (F.floor(size * at / PIECES).cast("int") for at in (i, i + 1))
        left = F.substring("word", F.lit(1), start)
        right = F.substring("word", end + 1 + longer, length)
        return F.struct(
            F.concat_ws("\x00", F.lit(str(i)), size.cast("string"), left, right).alias("key"),
            (end - start).alias("gap"),
            F.lit(i == PIECES - 1).alias("last"),
            start.alias("start"),
            F.lit(not longer).alias("asks"),
            (size > 0).alias("some"),
        )

    every = F.array(*[cut(longer, i) for longer in (0, 1) for i in range(PIECES)])
    cuts = words.select("word", "n", F.inline(every)).filter("some")
    return cuts.select("key", "gap", "last", "start", "asks", F.lit(True).alias("answers"), "word", "n")


def _with_chunks(cuts: DataFrame) -> DataFrame:
    """``cuts`` with the group ``a, b`` in which a row asks, answers or both.

    A block of more than ``CHUNK`` words is dealt to chunks; those who ask in
    chunk ``a`` meet those who answer in chunk ``b`` in a group of their own.
    """
    large = cuts.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > CHUNK)
    large = stage(large.select("key", F.ceil(F.col("rows") / CHUNK).cast("int").alias("chunks")))
    whole = cuts.withColumns({"a": F.lit(0), "b": F.lit(0)})
    if large.isEmpty():
        return whole
    own = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    dealt = cuts.join(large, "key").withColumn("own", own)
    others = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    columns = [F.col(c) for c in cuts.columns if c not in ("asks", "answers")]
    asking = dealt.filter("asks").select(*columns, F.lit(True).alias("asks"), F.lit(False).alias("answers"), F.col("own").alias("a"), others.alias("b"))
    answering = dealt.select(*columns, F.lit(False).alias("asks"), F.lit(True).alias("answers"), others.alias("a"), F.col("own").alias("b"))
    small = whole.join(large, "key", "left_anti")
    return small.unionByName(asking).unionByName(answering)


class _Index:
    """Words by position and letter, 64 to a bit set, for blocks whose gap has one size.

    ``bits[p, c, k]`` is the set of the words of column ``k`` with letter ``c``
    at place ``p`` of the gap. A block begins a new column, so a word that asks
    reads its own block's columns only.
    """

    def __init__(self, gap: int) -> None:
        self.gap = gap
        self.most_columns = max(1, min(COLUMNS, CELLS // (gap + 1)))
        self.columns = 0
        self.words: list[str] = []
        self.counts: list[int] = []
        self.parts: list[str] = []
        self.longer: list[bool] = []
        self.place: list[int] = []
        self.asking: list[tuple[str, str, int, int, int, bool]] = []

    def add(self, rows: list[tuple]) -> None:
        """One block: rows of ``last, start, asks, answers, word, n, size of the key's shorter word``."""
        first, at = self.columns, 0
        for last, start, asks, answers, word, n, size in rows:
            if answers:
                longer = len(word) > size
                self.words.append(word)
                self.counts.append(n)
                self.parts.append(word[start : start + self.gap + longer].ljust(self.gap + 1, "\0"))
                self.longer.append(longer)
                self.place.append(first * 64 + at)
                at += 1
        self.columns += -(-at // 64)
        if not at:
            return
        for last, start, asks, answers, word, n, size in rows:
            if asks:
                part = word[start : start + self.gap].ljust(self.gap + 1, "\0")
                self.asking.append((word, part, n, first, self.columns, last))

    def full(self) -> bool:
        return self.columns >= self.most_columns

    def _codes(self, parts: list[str]) -> np.ndarray:
        return np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).reshape(-1, self.gap + 1)

    def pairs(self) -> Iterator[pa.RecordBatch]:
        """``word, near, near_n``, each near pair once in either direction."""
        if not self.asking:
            return
        both = np.concatenate([self._codes(self.parts), self._codes([a[1] for a in self.asking])])
        letters, codes = np.unique(both, return_inverse=True)
        codes = codes.reshape(both.shape)
        known, asked = codes[: len(self.parts)], codes[len(self.parts) :]
        place = np.array(self.place, np.int64)
        column, bit = place >> 6, np.uint64(1) << (place & 63).astype(np.uint64)
        bits = np.zeros((self.gap + 1, len(letters), self.columns), np.uint64)
        for p in range(self.gap + 1):
            np.bitwise_or.at(bits[p], (known[:, p], column), bit)
        longer = np.array(self.longer)
        same_size, one_more = np.zeros(self.columns, np.uint64), np.zeros(self.columns, np.uint64)
        np.bitwise_or.at(same_size, column[~longer], bit[~longer])
        np.bitwise_or.at(one_more, column[longer], bit[longer])
        number = np.full(self.columns * 64, -1, np.int64)
        number[place] = np.arange(len(place))

        first = np.array([a[3] for a in self.asking], np.int64)
        width = np.array([a[4] for a in self.asking], np.int64) - first
        last = np.array([a[5] for a in self.asking])
        words = pa.array(self.words, pa.string())
        counts = pa.array(self.counts, pa.int64())
        askers = pa.array([a[0] for a in self.asking], pa.string())
        asker_counts = pa.array([a[2] for a in self.asking], pa.int64())
        ends = np.cumsum(width)
        for begin in range(0, int(ends[-1]), SIDE_BY_SIDE):
            job = np.arange(begin, min(begin + SIDE_BY_SIDE, int(ends[-1])))
            who = np.searchsorted(ends, job, side="right")
            lane = first[who] + job - (ends - width)[who]
            replaced, inserted = self._near(bits, asked[who], lane, last[who], same_size[lane], one_more[lane])
            for found, mutual in ((replaced, False), (inserted, True)):
                hit = np.flatnonzero(found)
                spread = np.unpackbits(found[hit].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
                row, at = np.nonzero(spread)
                one = pa.array(who[hit[row]])
                other = pa.array(number[lane[hit[row]] * 64 + at])
                if not len(one):
                    continue
                yield self._batch(askers.take(one), words.take(other), counts.take(other))
                if mutual:
                    yield self._batch(words.take(other), askers.take(one), asker_counts.take(one))

    @staticmethod
    def _batch(word: pa.Array, near: pa.Array, n: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([word, near, n], names=["word", "near", "near_n"])

    def _near(self, bits, asked, lane, last, same_size, one_more) -> tuple[np.ndarray, np.ndarray]:
        """Words with one letter replaced, and with one more letter, as bit sets for each comparison.

        ``exact``: the letters so far agree. ``replaced``: all but one do.
        ``moved``: they agree with one letter of the word skipped. A pair whose
        extra letter could also be told to stand further back is left to the
        piece there, so it is found once.
        """
        exact = same_size | one_more
        replaced, moved = np.zeros_like(exact), exact
        for j in range(self.gap):
            here, next_ = bits[j, asked[:, j], lane], bits[j + 1, asked[:, j], lane]
            replaced = (replaced & here) | (exact & ~here)
            exact = exact & here
            moved = (moved & next_) | exact
        further = np.where(last, np.uint64(0), exact)
        return replaced & same_size, moved & one_more & ~further


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, near, near_n`` for all ordered pairs of ``words`` (``word, n``) exactly one edit apart.

    Words meet in blocks that leave out the piece of the edit. A task builds a
    bit-sliced index over its blocks, with one bit set per place and letter,
    and follows the words with no and with one difference through the letters,
    64 words at a time. No word is compared outside its blocks; large blocks
    are compared in pairs of bounded chunks.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held, block = None, [], None
        for batch in batches:
            for key, a, b, gap, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, a, b) != block:
                    if held:
                        index.add(held)
                    if index is None or index.gap != gap or index.full():
                        if index is not None:
                            yield from index.pairs()
                        index = _Index(gap)
                    held, block = [], (key, a, b)
                    size = int(key.split("\x00", 2)[1])
                held.append((*row, size))
        if held:
            index.add(held)
            yield from index.pairs()

    dealt = _with_chunks(blocks(words))
    grouped = dealt.repartition("key", "a", "b").sortWithinPartitions("gap", "key", "a", "b")
    rows = grouped.select("key", "a", "b", "gap", "last", "start", "asks", "answers", "word", "n")
    return rows.mapInArrow(find, "word string, near string, near_n bigint")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms`` (``word, form``): the end of each chain, whose known part doubles each round.

    A form occurs at least twice as often as its word, so chains are acyclic and
    rounds grow with the logarithm of the logarithm of the largest count.
    """
    at = stage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not at.filter("moved").isEmpty():
        further = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = at.join(further, "root", "left")
        at = stage(joined.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
    return at.select("word", "root")


def spelling_variants(
    docs: DataFrame, shortest: int = 5, fewest: int = 3, factor: int = 2, id_column: str = "doc_id"
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of ``docs`` (``doc_id, text``).

    Words are the maximal runs of ASCII and Latin-1 letters, A-Z in lower case,
    with at least ``shortest`` code points and ``fewest`` occurrences; one run
    in ``EDITED`` loses a letter first, as :func:`damaged` says. The form of a
    word is the near word (one edit apart) of most occurrences, of several the
    first in code-point order, if it occurs at least ``factor`` times as often.
    The root is the last word on the way from form to form.

    Null and empty texts have no words; a row without an id counts with an
    empty id, repeated rows count each, and other columns are not read. No
    words give an empty table. Texts and words of any length are taken whole.
    """
    spark = docs.sparkSession
    words = stage(word_counts(docs, shortest, fewest, id_column))
    # A word is copied once for each piece and role.
    with shuffle_sized(spark, 4 * PIECES * size_in_bytes(words)):
        near = near_pairs(words).groupBy("word").agg(
            F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("most")
        )
        often = -F.col("most.less")
        is_form = often >= factor * F.col("n")
        joined = words.join(near, "word", "left").select(
            "word",
            F.when(is_form, F.col("most.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(is_form, often).alias("form_n"),
        )
        found = stage(joined)
        roots = _roots(found.filter("form IS NOT NULL"))
        rooted = found.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
