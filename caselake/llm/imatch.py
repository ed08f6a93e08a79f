"""I-Match fingerprints of whole texts. Built-in expressions only."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.rows import text_of, utf8_sha256
from caselake.session import stage

# The share of documents that hold a term, from and up to which it identifies text.
RAREST, COMMONEST = 0.0005, 0.2
# Random subsets of the lexicon, each hashed on its own to so many hexadecimal digits, and how many draws a term has: it is
# in the subsets that these give, so subsets overlap. The number of subsets is a power of two.
SUBSETS, DIGITS, DRAWS = 128, 4, 2
_BITS = SUBSETS.bit_length() - 1
_EMPTY = "." * DIGITS
# A lexicon of up to this many terms, some 30 MB, is broadcast; a larger one is joined by a shuffle.
MOST_BROADCAST = 1_000_000
# Letters and digits; anything else ends a term.
_BREAK = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """The distinct terms of a text as 64-bit hashes."""
    words = F.filter(F.split(F.lower(text), _BREAK), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, rarest: float = RAREST, commonest: float = COMMONEST) -> DataFrame:
    """Column ``term``: the terms whose inverse document frequency lies in the band. Counts all of ``docs`` (``text``).

    A term of the band is in at least ``rarest`` of all documents, so there
    are no more of them than the mean number of distinct terms of a document
    over ``rarest``, whatever the number of documents.
    """
    total = max(1, docs.count())
    each = docs.select(F.explode(terms(F.col("text"))).alias("term"))
    counted = each.groupBy("term").agg((F.count(F.lit(1)) / total).alias("share"))
    return counted.filter(F.col("share").between(rarest, commonest)).select("term")


def _hashed(found: Column, instead: Column) -> Column:
    """The fingerprint of the lexicon terms ``found``, or of the number ``instead`` if there are none.

    Each draw turns a term's hash by some bits, and the top bits name a
    subset. So the sorted turned hashes hold the subsets' members one subset
    after the other, and one pass hashes them all.
    """

    def part(term: Column) -> Column:
        return F.shiftrightunsigned(term.bitwiseXOR(F.lit(-(2**63))), 64 - _BITS).cast("int")

    def turned(draw: int) -> Column:
        bits = draw * _BITS
        left, right = lambda t: F.shiftleft(t, bits), lambda t: F.shiftrightunsigned(t, 64 - bits)
        return F.transform(found, lambda t: left(t).bitwiseOR(right(t))) if draw else found

    def digits(number: Column) -> Column:
        return F.right(F.concat(F.lit("0" * DIGITS), F.hex(number)), F.lit(DIGITS))

    def state(at: Column, hashed: Column, written: Column) -> Column:
        return F.struct(at.alias("at"), hashed.alias("hashed"), written.alias("written"))

    def closed(s: Column) -> Column:
        return F.when(s["at"] < 0, "").otherwise(F.concat(s["written"], digits(s["hashed"])))

    def add(s: Column, term: Column) -> Column:
        here = part(term)
        more = state(s["at"], F.xxhash64(s["hashed"], term), s["written"])
        gap = F.repeat(F.lit(_EMPTY), here - s["at"] - 1)
        return F.when(here == s["at"], more).otherwise(state(here, F.xxhash64(here, term), F.concat(closed(s), gap)))

    def finish(s: Column) -> Column:
        return F.concat(closed(s), F.repeat(F.lit(_EMPTY), SUBSETS - 1 - s["at"]))

    start = state(F.lit(-1), F.lit(0).cast("bigint"), F.lit(""))
    drawn = F.concat(*[turned(draw) for draw in range(DRAWS)])
    listed = F.aggregate(F.sort_array(drawn), start, add, finish)
    return F.when(F.size(found) > 0, listed).otherwise(F.repeat(digits(F.xxhash64(instead)), SUBSETS))


def likeness(one: Column, other: Column) -> Column:
    """The share of subsets, of those not empty in both, in which two fingerprints agree."""

    def part(fingerprint: Column, i: Column) -> Column:
        return fingerprint.substr(i * DIGITS + 1, F.lit(DIGITS))

    at = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
    filled = F.filter(at, lambda i: (part(one, i) != _EMPTY) | (part(other, i) != _EMPTY))
    same = F.filter(filled, lambda i: part(one, i) == part(other, i))
    return F.size(same) / F.size(filled)


def _literal(numbers: Sequence[int | None]) -> Column:
    """An array literal of bigints, as text so that its length costs nothing."""
    return F.from_json(F.lit(json.dumps(list(numbers))), "array<bigint>")


def _part_of(doc: Column, bounds: Sequence[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``doc``: a binary search; 0 for null."""
    sorted_bounds = _literal(bounds)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        _literal(steps),
        F.lit(0).cast("bigint"),
        lambda low, step: F.when(F.get(sorted_bounds, low + step - 1) <= doc, low + step).otherwise(low),
    )


def with_next(docs: DataFrame, doc: Column, text: Column) -> DataFrame:
    """``part, nth, guest, doc, text, next``: each text and the one after it by descending id; the last one's is the first.

    Ids are cut into ranges at approximate quantiles. A range's first document
    also goes to the range before it, as a guest, so one shuffle of the texts
    by range is enough; guests have no ``next`` and only serve the row before.
    Rows without an id come last and rows of one id in the order of their
    text's hash.
    """
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    bounds = docs.select(doc.alias("doc")).agg(F.percentile_approx("doc", shares, 20 * ranges)).first()[0] or []
    bounds = sorted(set(bounds))
    keyed = docs.select(doc.alias("doc"), text.alias("text")).withColumn("part", _part_of(F.col("doc"), bounds))
    # At most one row per range.
    firsts = {row["part"]: row["first"] for row in keyed.groupBy("part").agg(F.max("doc").alias("first")).collect()}
    taken = sorted(firsts)
    host = {part: taken[(i + 1) % len(taken)] for i, part in enumerate(taken)}
    every = range(len(bounds) + 1)
    leads = F.col("doc").eqNullSafe(F.get(_literal([firsts.get(p) for p in every]), F.col("part")))
    home = F.struct(F.col("part").alias("part"), F.lit(False).alias("guest"))
    away = F.struct(F.get(_literal([host.get(p, 0) for p in every]), F.col("part")).alias("part"), F.lit(True).alias("guest"))
    copies = F.when(leads, F.array(home, away)).otherwise(F.array(home))
    dealt = keyed.select("doc", "text", F.inline(copies))
    order = Window.partitionBy("part").orderBy("guest", F.col("doc").desc_nulls_last(), F.xxhash64("text"))
    return dealt.select(
        "part",
        F.row_number().over(order).alias("nth"),
        "guest",
        "doc",
        "text",
        F.lead("text").over(order).alias("next"),
    )


def fingerprints(
    docs: DataFrame, rarest: float = RAREST, commonest: float = COMMONEST, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row of ``docs``.

    The terms of a text whose inverse document frequency lies in the band meet
    ``SUBSETS`` random subsets of the lexicon, each term in up to ``DRAWS`` of
    them; a subset's distinct terms are sorted and hashed. Equal texts have
    equal fingerprints, and subsets change one by one as terms do. The edited
    text has its last ``floor(n_chars / 2)`` code points replaced by the first
    ones of the next document. ``near_edited`` and ``near_next`` are the shares
    of subsets equal to those of the edited text and of the next document.

    A text without a term of the band uses the hash of all its terms, one
    without terms the hash of the text, in every subset. Null text is empty.
    Rows without an id come after all others, repeated rows next to each other;
    an empty table gives an empty table.
    """
    doc, text = F.col(f"`{id_column}`"), text_of(text_column)
    known = stage(lexicon(docs.select(text.alias("text")), rarest, commonest))
    mark = F.lit(0).cast("bigint")
    known = known.union(known.sparkSession.range(1).select(mark.alias("term")))
    if known.count() <= MOST_BROADCAST:
        known = F.broadcast(known)

    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next", F.lit(1), half))
    both = with_next(docs, doc, text).withColumn("edited", F.when(~F.col("guest"), edited))
    both = both.withColumns({"own": terms(F.col("text")), "other": terms(F.coalesce("edited", F.lit("")))})

    def instead(found: str, written: str) -> Column:
        return F.when(F.size(found) > 0, F.xxhash64(F.sort_array(found))).otherwise(F.xxhash64(written))

    about = F.struct(
        F.col("doc").alias("doc"),
        F.col("guest").alias("guest"),
        size.cast("bigint").alias("n_chars"),
        utf8_sha256(F.col("edited")).alias("edited_sha256"),
        instead("own", "text").alias("own"),
        instead("other", "edited").alias("other"),
    )
    first = F.struct(mark.alias("term"), F.lit(0).alias("kind"), about.alias("about"))
    none = F.lit(None)

    def listed(found: str, kind: int) -> Column:
        return F.transform(found, lambda t: F.struct(t.alias("term"), F.lit(kind).alias("kind"), none.alias("about")))

    one_by_one = F.inline(F.concat(F.array(first), listed("own", 1), listed("other", 2)))
    met = both.select("part", "nth", one_by_one).join(known, "term")
    gathered = met.groupBy("part", "nth").agg(
        F.collect_list(F.when(F.col("kind") == 1, F.col("term"))).alias("own"),
        F.collect_list(F.when(F.col("kind") == 2, F.col("term"))).alias("other"),
        F.first("about", ignorenulls=True).alias("about"),
    )
    printed = gathered.select(
        "part",
        "nth",
        "about",
        _hashed(F.col("own"), F.col("about.own")).alias("fingerprint"),
        _hashed(F.col("other"), F.col("about.other")).alias("edited_fingerprint"),
    )
    following = F.lead("fingerprint").over(Window.partitionBy("part").orderBy("nth"))
    compared = printed.withColumn("following", following).filter(~F.col("about.guest"))
    return compared.select(
        F.col("about.doc").alias("doc_id"),
        "about.n_chars",
        "about.edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("following")).alias("near_next"),
    )
