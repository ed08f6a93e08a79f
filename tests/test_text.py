from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from caselake import constants as K
from caselake.functions import text
from caselake.plans.silver import standardize_names


def column(spark, values, fn, name="x"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")
    return [r[1] for r in df.select("i", fn(F.col(name))).orderBy("i").collect()]


def test_display_name_trims_and_capitalises(spark):
    got = column(spark, ["  bob JONES ", "anna-maria o'neil", "", None], text.display_name)
    assert got == ["Bob Jones", "Anna-maria O'neil", "", None]


def test_strip_special_keeps_spaces_and_drops_accents(spark):
    got = column(spark, [" St. Mary's & Co. ", "Élan 7", None], text.strip_special)
    assert got == [" St Marys  Co ", "lan 7", None]


@pytest.mark.parametrize("ansi", ["true", "false"], indirect=True)
def test_name_parts_of_edge_cases(spark, ansi):
    names = [
        None, "", " ", "Mr.", "Anna", "Anna Lee", "Anna M K Lee", "Dr. bob  jones jr.", "(Jr)", "Ph.D. Ann", "Bob IV",
    ]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    rows = standardize_names(df).orderBy("i").collect()
    parts = [(r.name_clean, r.FirstName, r.LastName, r.MiddleName) for r in rows]
    assert parts == [
        (None, None, None, ""),
        ("", "", None, ""),
        ("", "", None, ""),
        ("", "", None, ""),
        ("Anna", "Anna", None, ""),
        ("Anna Lee", "Anna", "Lee", ""),
        ("Anna M K Lee", "Anna", "Lee", "M K"),
        ("Bob Jones", "Bob", "Jones", ""),
        ("", "", None, ""),
        ("Ph.d. Ann", "Ph.d.", "Ann", ""),
        ("Bob Iv", "Bob", "Iv", ""),
    ]


def without_titles(name):
    return " ".join(t for t in name.split() if t.strip(K.TITLE_PUNCTUATION).upper() not in K.TITLE_WORDS)


def test_strip_words_agrees_with_the_rule_on_generated_names(spark):
    rng = random.Random(7)
    words = [*K.TITLE_WORDS, "bob", "Mrs", "drake", "Sonja", "iiii", "ß", "ıı", "ſr", "Ph.D", "x", "MR-DR", "Dr.Jr"]
    marks = ["", "", "", ".", ",", "(", ")", ".,", "(.", "-"]
    gaps = [" ", "  ", "\t", " \n", " ", " ", "\x1c", "\x85"]

    def name():
        tokens = []
        for _ in range(rng.randint(0, 5)):
            word = rng.choice(words)
            word = rng.choice([word, word.lower(), word.title()])
            tokens.append(rng.choice(gaps) + rng.choice(marks) + word + rng.choice(marks))
        return "".join(tokens) + rng.choice(["", *gaps])

    names = [name() for _ in range(4000)]
    assert column(spark, names, text.strip_words) == [without_titles(n) for n in names]


def test_strip_words_is_idempotent_and_takes_other_words(spark):
    once = column(spark, ["Dr. Bob Jr. Jr", "a dr b"], text.strip_words)
    assert column(spark, once, text.strip_words) == once
    assert column(spark, ["+Sir+ Bob", "sir"], lambda c: text.strip_words(c, ["Sir"], "+")) == ["Bob", ""]


def test_gender_codes(spark):
    raw = ["M", " male", "MALE ", "f", "Female ", "", "  ", None, "x", "women"]
    got = column(spark, raw, lambda c: text.normalize_codes(c, K.GENDER_CODES))
    assert got == ["M", "M", "M", "F", "F", "UN", "UN", "UN", "UN", "UN"]


def test_blood_types(spark):
    got = column(spark, [" a+", "O-", "  ", "", None], text.normalize_codes)
    assert got == ["A+", "O-", "UN", "UN", "UN"]
