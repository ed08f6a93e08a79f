"""Personal data in texts: fixed rules, and further spans that weak labelers vote for. Built-in expressions only."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.llm.rows import text_of
from caselake.session import shuffle_sized, size_in_bytes, stage

# The kinds in their order, and the rules for each. A rule begins where nothing that it could
# begin with stands before, or where the last match ended; that and the possessive repeats
# keep matching linear and find the same spans as the plain patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
RULES = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this has no match.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
_AT, _DOT = r"(?:@|\x20?[(\[]\x20?at\x20?[)\]]\x20?)", r"(?:\.|\x20?[(\[]\x20?dot\x20?[)\]]\x20?)"
# What may be personal data: addresses also as people disguise them, network addresses, telephone and card numbers in
# their usual forms, so that neighbours are told apart, and other chains of seven digits or more.
CANDIDATE = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)*+"
    r"|(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
    r"|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])"
    r"|(?:\+[0-9]{1,3}[\x20.-]?)?+(?:\([0-9]{2,4}\)|(?<![0-9])[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9]|[\x20-][0-9]{4}(?![0-9]))"
    r"|(?<![0-9])(?:[0-9]{4}[\x20-]){3}[0-9]{4}(?![0-9])|(?<![0-9])[0-9]{12,19}(?![0-9])"
    r"|(?<![0-9])[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+"
)
# Gazetteers, and the words whose nearness speaks for a kind or against any.
DOMAINS = "at au be biz br ca ch cn com de dk edu es eu fr gov ie in info int io it jp mil net nl no nz org pl pt ru se uk us"
ISSUERS = "4|5[1-5]|2[2-7]|3[0-8]|6011|62|64|65"
CALLING_CODES = "1|2[07]|3[0-469]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58]"
UNROUTED = r"0|127|22[4-9]|23[0-9]|2[4-9][0-9]|[3-9][0-9]{2}"
CUES = {
    "email": "mail|contact|write to|reach",
    "ip": r"\bip\b|host|server|addr",
    "card": "card|visa|master|credit|debit|amex|payment",
    "phone": r"\btel|phone|call|fax|mobile|cell",
}
OTHER_CUES = r"version|isbn|issn|\bno\.|\bnr\.|order|section|article|chapter|figure|table|licen[cs]e|token|key|hash"
CONTEXT = 40
# Each labeler votes for (1), against (-1) or not at all (0).
LABELERS = ("rule", "gazetteer", "context", "shape", "border")
_SIZES = (10, 11, 13, 16, 17)
ROUNDS, STEPS, RATE, DECAY = 60, 400, 1.0, 1e-3


def matches(text: Column, pattern: str, needed: str, number: int, context: int = 0) -> Column:
    """All matches of ``pattern``: kind ``number``, ``nth``, code points between the last match and it, the hit, what is around."""
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def match(pieces: Column, hit: Column, at: Column) -> Column:
        before, after = F.get(pieces, at), F.get(pieces, at + 1)
        return F.struct(
            F.lit(number).alias("kind"),
            at.alias("nth"),
            F.char_length(before).cast("bigint").alias("gap"),
            hit.alias("hit"),
            (F.right(before, F.lit(context)) if context else F.lit("")).alias("before"),
            (F.left(after, F.lit(1)) if context else F.lit("")).alias("after"),
        )

    # The pieces are held in an array of one, so that they are cut once.
    found = F.flatten(F.transform(F.array(pieces), lambda p: F.transform(hits, lambda hit, at: match(p, hit, at))))
    return F.when(text.rlike(needed), found)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""

    def value(at: Column) -> Column:
        digit = F.substring(digits, F.char_length(digits) - at, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(at % 2 == 0, digit).otherwise(doubled)

    places = F.sequence(F.lit(0), F.char_length(digits) - 1)
    return F.aggregate(F.transform(places, value), F.lit(0), add) % 10 == 0


_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _holds(kind: str, hit: Column) -> Column:
    """Whether a match of a rule also passes its check."""
    size = F.char_length(_digits(hit))
    if kind == "ip":
        return hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(size.between(12, 19), luhn(_digits(hit))).otherwise(False)
    if kind == "phone":
        return size.between(9, 15)
    return F.lit(True)


def _by_kind(values: Mapping[str, Column], otherwise: Column) -> Column:
    return reduce(lambda rest, kind: F.when(F.col("kind") == KINDS.index(kind), values[kind]).otherwise(rest), values, otherwise)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def with_votes(found: DataFrame) -> DataFrame:
    """``found`` (``hit, before, after``) with the ``kind`` that its shape suggests, the votes, and features of the shape."""
    hit, digits = F.col("hit"), _digits(F.col("hit"))
    size = F.char_length(digits)
    address = hit.rlike("[@A-Za-z]") & ~hit.rlike("^[0-9A-Fa-f:]+$")
    ip = hit.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") | hit.contains(":")
    plus = hit.startswith("+")
    kind = F.when(address, 0).when(ip, 1).when(~plus & (size >= 12), 2).otherwise(3).cast("int")
    kinded = found.withColumns({"kind": kind, "size": size, "digits": digits})

    size, digits = F.col("size"), F.col("digits")
    domain = F.lower(F.regexp_extract(hit, "([A-Za-z0-9-]+)$", 1))
    known_domain = domain.isin(DOMAINS.split())
    whole = {k: hit.rlike(f"^(?:{RULES[k]})$") & _holds(k, hit) for k in KINDS}
    fails = {
        "email": F.lit(False),
        "ip": ~hit.contains(":") & ~_holds("ip", hit),
        "card": F.when(size.between(12, 19), ~luhn(digits)).otherwise(True),
        "phone": ~size.between(7, 15),
    }
    listed = {
        "email": _vote(known_domain, ~known_domain),
        "ip": _vote(~hit.contains(":") & ~hit.rlike(rf"^({UNROUTED})\."), hit.rlike(rf"^({UNROUTED})\.")),
        "card": _vote(digits.rlike(f"^({ISSUERS})"), ~digits.rlike(f"^({ISSUERS})")),
        "phone": _vote(plus & digits.rlike(f"^({CALLING_CODES})"), F.lit(False)),
    }
    shaped = {
        "email": _vote(hit.rlike(r"^[A-Za-z0-9][^@]*[A-Za-z0-9].?[@(\[ ]") & hit.rlike(r"[.)\]]"), hit.rlike(r"\.\.|^[.%+-]")),
        "ip": _vote(hit.rlike(r"^(0|[1-9][0-9]*)(\.(0|[1-9][0-9]*)){3}$") | hit.contains(":"), hit.rlike(r"(^|\.)0[0-9]")),
        "card": _vote(hit.rlike("^[0-9]{13,16}$|^[0-9]{4}([ -][0-9]{4}){3}$|^[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}$"), hit.rlike(r"[().]")),
        "phone": _vote(hit.rlike(r"\(?[0-9]{2,4}\)?[ .-]+[0-9]{3,4}[ .-][0-9]{3,4}$"), hit.rlike("^[0-9]+$")),
    }
    before = F.lower("before")
    near = _by_kind({k: before.rlike(v) for k, v in CUES.items()}, F.lit(False))
    # Letters, digits and quotes at a border belong to a larger token.
    joined = F.col("before").rlike(r"[\p{L}\p{N}_=#/\"]$") | F.col("after").rlike(r"^[\p{L}\p{N}_=#/\"]")
    return kinded.withColumns(
        {
            "rule": _vote(_by_kind(whole, F.lit(False)), _by_kind(fails, F.lit(False))),
            "gazetteer": _by_kind(listed, F.lit(0)),
            "context": _vote(near, before.rlike(OTHER_CUES)),
            "shape": _by_kind(shaped, F.lit(0)),
            "border": _vote(~joined, joined),
            "many": sum((F.when(size >= s, 1).otherwise(0) for s in _SIZES), F.lit(0)),
            "split": hit.rlike(r"[^0-9A-Za-z]").cast("int"),
        }
    )


_FEATURES = ("many", "split")
Pattern = tuple[tuple[int, ...], tuple[int, ...], int]


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def reliabilities(patterns: Sequence[Pattern]) -> list[float]:
    """How likely each pattern of votes is right, by expectation-maximisation over the labelers' hit and error rates.

    A labeler votes by itself given the truth. What the rule accepts is true,
    what its check refuses is not; the rest begins with the majority of its votes.
    """
    known = {1: 1.0, -1: 0.0}
    true = [known.get(votes[0], _sigmoid(sum(votes))) for votes, _, _ in patterns]
    for _ in range(ROUNDS):
        # One imagined span of either class for every possible vote.
        seen = [[{v: 1.0 for v in (-1, 0, 1)} for _ in LABELERS] for _ in range(2)]
        size = [1.0, 1.0]
        for (votes, _, n), p in zip(patterns, true):
            for y, share in ((1, p), (0, 1 - p)):
                size[y] += n * share
                for of, vote in zip(seen[y], votes):
                    of[vote] += n * share
        logs = [[{v: math.log(x / (size[y] + 2)) for v, x in of.items()} for of in seen[y]] for y in range(2)]
        prior = math.log(size[1] / size[0])
        for i, (votes, _, _) in enumerate(patterns):
            odds = prior + sum(logs[1][k][v] - logs[0][k][v] for k, v in enumerate(votes))
            true[i] = known.get(votes[0], _sigmoid(odds))
    return true


def _inputs(votes: Sequence[int], features: Sequence[int]) -> list[float]:
    many = [float(features[0] == i) for i in range(len(_SIZES) + 1)]
    return [1.0, *[float(v > 0) for v in votes], *[float(v < 0) for v in votes], *many, float(features[1])]


def classifier(patterns: Sequence[Pattern], true: Sequence[float]) -> list[float]:
    """Weights of a logistic regression of the estimated truth on votes and features, each pattern as often as it occurs."""
    rows = [(_inputs(votes, features), n, p) for (votes, features, n), p in zip(patterns, true)]
    total = sum(n for _, n, _ in rows)
    weights = [0.0] * len(rows[0][0])
    for _ in range(STEPS):
        slope = [DECAY * w for w in weights]
        for x, n, p in rows:
            off = n * (_sigmoid(sum(w * v for w, v in zip(weights, x))) - p) / total
            slope = [s + off * v for s, v in zip(slope, x)]
        weights = [w - RATE * s for w, s in zip(weights, slope)]
    return weights


def fit(candidates: DataFrame) -> dict[int, list[float]]:
    """The span classifier's weights per kind, from all ``candidates``.

    Only the distinct patterns of votes and features reach the driver, counted:
    at most 3 ** 5 votes by 12 features for each of four kinds, however many spans there are.
    """
    counted = candidates.groupBy("kind", *LABELERS, *_FEATURES).agg(F.count(F.lit(1)).alias("n"))
    by_kind: dict[int, list[Pattern]] = {}
    for row in counted.orderBy("kind", *LABELERS, *_FEATURES).collect():
        pattern = (tuple(row[c] for c in LABELERS), tuple(row[c] for c in _FEATURES), row["n"])
        by_kind.setdefault(row["kind"], []).append(pattern)
    return {kind: classifier(patterns, reliabilities(patterns)) for kind, patterns in by_kind.items()}


def score(weights: Mapping[int, Sequence[float]]) -> Column:
    """The classifier's probability for a row of :func:`with_votes`."""

    def line(w: Sequence[float]) -> Column:
        n, many = len(LABELERS), len(_SIZES) + 1
        total = F.lit(w[0])
        for i, name in enumerate(LABELERS):
            total += F.when(F.col(name) > 0, w[1 + i]).when(F.col(name) < 0, w[1 + n + i]).otherwise(0.0)
        sizes = F.array(*map(F.lit, w[1 + 2 * n : 1 + 2 * n + many]))
        return total + F.get(sizes, F.col("many")) + F.col("split") * F.lit(w[-1])

    odds = reduce(lambda rest, kind: F.when(F.col("kind") == kind, line(weights[kind])).otherwise(rest), weights, F.lit(-40.0))
    return 1 / (1 + F.exp(-odds))


def _spans(found: DataFrame) -> DataFrame:
    """``found`` with ``start`` and ``end`` in code points instead of gaps."""
    size = F.char_length("hit").cast("bigint")
    so_far = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + size).over(so_far)
    return found.withColumn("end", end).withColumn("start", F.col("end") - size).drop("gap", "nth")


def _apart(base: DataFrame, more: DataFrame) -> DataFrame:
    """``base`` and those of ``more`` that overlap none of it."""
    columns = ("row", "kind", "start", "end")
    both = base.select(*columns, F.lit(True).alias("base")).union(more.select(*columns, F.lit(False).alias("base")))
    order = Window.partitionBy("row").orderBy("start")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    clear = (F.coalesce("before", F.lit(0)) <= F.col("start")) & (F.coalesce("after", F.col("end")) >= F.col("end"))
    return both.withColumns({"before": before, "after": after}).filter(F.col("base") | clear).drop("before", "after")


def personal_data(
    docs: DataFrame, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans`` of each row of ``docs``.

    ``base_spans`` are what the rules of ``RULES`` find, each kind by itself:
    ``kind:start:end`` in code points, the end exclusive, ordered by start and
    kind. The counts are of these. ``spans`` has further ones: chains of digits and addresses
    in wider forms, on which five labelers vote (the rule, gazetteers, words
    before, shape, borders). Expectation-maximisation over all candidates
    estimates how reliable each labeler is, and with it how likely each
    candidate is true; a logistic regression learns that from votes and
    shape, and candidates that it gives ``threshold`` stay, unless they overlap
    a base span or fail a check that all of their kind pass.

    Null and empty texts have no spans and empty arrays. Rows are independent,
    also repeated ones and those without an id; texts are whole, other columns
    are not read, and an empty table gives an empty one.
    """
    text = text_of(text_column)
    texts = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), text.alias("text"))
    every = [matches(F.col("text"), RULES[k], NEEDED[k], i) for i, k in enumerate(KINDS)]
    every.append(matches(F.col("text"), CANDIDATE, r"[0-9@]|[(\[]\x20?at", len(KINDS), CONTEXT))
    none = F.filter(every[0], lambda m: F.lit(False))
    listed = F.flatten(F.filter(F.array(*every), lambda m: m.isNotNull()))
    # The number of a row is written down with what was found in it.
    found = stage(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(listed, none).alias("found")))
    with shuffle_sized(docs.sparkSession, size_in_bytes(found)):
        hits = _spans(found.select("row", F.inline("found")))
        base = hits.filter(_by_kind({k: _holds(k, F.col("hit")) for k in KINDS}, F.lit(False)))
        candidates = stage(with_votes(hits.filter(F.col("kind") == len(KINDS))).drop("hit", "before", "after", "digits"))
        kept = candidates.filter((F.col("rule") >= 0) & (score(fit(candidates)) >= threshold))
        names = F.array(*map(F.lit, KINDS))
        span = F.concat_ws(":", F.get(names, F.col("kind")), F.col("start"), F.col("end"))
        placed = F.struct("start", "kind", "end", span.alias("span"))
        counts = [F.count_if(F.col("base") & (F.col("kind") == i)).alias(f"n_{k}") for i, k in enumerate(KINDS)]
        gathered = _apart(base, kept).groupBy("row").agg(
            *counts,
            F.sort_array(F.collect_list(F.when(F.col("base"), placed))).alias("base"),
            F.sort_array(F.collect_list(placed)).alias("every"),
        )
        joined = found.select("row", "doc_id").join(gathered, "row", "left")
    empty = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("bigint")).alias(f"n_{k}") for k in KINDS],
        F.coalesce(F.col("base.span"), empty).alias("base_spans"),
        F.coalesce(F.col("every.span"), empty).alias("spans"),
    )
