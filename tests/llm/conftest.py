from __future__ import annotations

import pytest

# What every operator has to stand: nulls, empties, repeats, no id, and a long text.
LONG = "langes wort und noch eins " * 4000
TEXTS = [
    (1, "one two three four five six seven eight nine ten"),
    (2, "one two three four five six seven eight nine ten"),
    (2, "one two three four five six seven eight nine ten"),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (None, "no id here, and so no links"),
    (None, None),
    (6, LONG),
    (7, LONG + "x"),
    (8, "ein Satz\nzwei\n\n"),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id bigint, text string").coalesce(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def clashing(docs):
    """Columns with names that operators use inside or give back."""
    from pyspark.sql import functions as F

    names = "row key doc part nth at line lines lost version n kept node component size n_lines rest score pieces".split()
    return docs.withColumns({name: F.lit(f"own {name}") for name in names})
