"""Person-name and free-text standardisation."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselake import constants as K

# Unicode white space plus the four ASCII separators that Python's str.split also splits on.
_GAP = r"(?U)[\s\x1c-\x1f]+"
_NOT_AFTER_TEXT = r"(?<![^\s\x1c-\x1f])"
_NOT_BEFORE_TEXT = r"(?![^\s\x1c-\x1f])"


def display_name(name: Column) -> Column:
    return F.initcap(F.trim(name))


def strip_special(text: Column, pattern: str = K.SPECIAL_CHARACTERS) -> Column:
    return F.regexp_replace(text, pattern, "")


def strip_words(
    text: Column,
    words: Iterable[str] = K.TITLE_WORDS,
    punctuation: str = K.TITLE_PUNCTUATION,
) -> Column:
    """Drop whole tokens that equal one of ``words`` (any case, punctuation around ignored).

    Done as one regular expression rather than split + filter + join: an array
    lambda would take the projection out of whole-stage code generation.
    """
    edge = "[" + re.escape(punctuation) + "]*"
    choice = "|".join(re.escape(word) for word in words)
    token = f"(?iuU){_NOT_AFTER_TEXT}{edge}(?:{choice}){edge}{_NOT_BEFORE_TEXT}"
    return F.trim(F.regexp_replace(F.regexp_replace(text, token, ""), _GAP, " "))


def name_tokens(clean_name: Column) -> Column:
    return F.split(F.trim(clean_name), r"\s+")


def first_name(tokens: Column) -> Column:
    return F.get(tokens, F.lit(0))


def last_name(tokens: Column) -> Column:
    return F.when(F.size(tokens) > 1, F.try_element_at(tokens, F.lit(-1)))


def middle_name(tokens: Column) -> Column:
    inner = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 2, F.lit(0)))
    return F.coalesce(F.array_join(inner, " "), F.lit(""))


def normalize_codes(
    raw: Column,
    codes: Mapping[str, Iterable[str]] | None = None,
    default: str = K.UNKNOWN_CODE,
) -> Column:
    """Upper-case, trimmed code of ``raw``.

    With ``codes`` (code -> accepted spellings) anything unlisted gets
    ``default``; without, only NULL and blank do.
    """
    key = F.upper(F.trim(raw))
    if codes is None:
        return F.coalesce(F.nullif(key, F.lit("")), F.lit(default))
    code = F.lit(None).cast("string")
    for value, spellings in codes.items():
        code = F.coalesce(code, F.when(key.isin(*spellings), F.lit(value)))
    return F.coalesce(code, F.lit(default))
