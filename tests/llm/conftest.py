from __future__ import annotations

import pytest
from pyspark.sql import functions as F

# Nulls, empty texts, repeated rows, ties, a long text, and columns with clashing names.
ROWS = [
    (1, "a b c d e f g h i j k l m n o p q r s t u v w x y z one two three four five six"),
    (2, "a b c d e f g h i j k l m n o p q r s t u v w x y z one two three four five seven"),
    (2, "a b c d e f g h i j k l m n o p q r s t u v w x y z one two three four five seven"),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (6, "two words"),
    (7, "Two  words"),
    (None, "a b c d e f g h i j k l m n o p q r s t u v w x y z one two three four five six"),
    (None, None),
    (8, "long " * 30_000 + "é ü"),
    (9, "x" * 100_000),
    (10, "mail me.too@b-c.example.org or 10.0.0.255, +1 (555) 123-4567, 4111 1111 1111 1111 password=0123456789abcdef01"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", None, n, "clash", 1, 2.0) for n, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, class int, score double")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where(F.lit(False))


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (6, None, None), (2, 0, 1)], "doc_id long, quality int, toxic int")
