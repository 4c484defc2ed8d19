import random

import pytest
from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and alpha beta gamma delta river stone cloud paper green silver night über été".split()


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows and ids."""
    r = random.Random(3)

    def text(n):
        return "".join(r.choice(WORDS) + r.choice([" ", " ", " ", "\n", ". "]) for _ in range(n))

    rows = [(i, text(r.choice([3, 20, 60, 120])), r.choice(["en", "fr", None]), r.choice(["b", "a", "ä", None]), 7)
            for i in range(60)]
    shared = "\n".join(text(12).replace("\n", " ") for _ in range(6))
    rows += [(100 + i, f"{text(4)}\n{shared}\n{text(30)}", "en", "a", None) for i in range(4)]
    rows += [(200, None, None, None, None), (201, "", "en", "a", 0), (202, " \t\n ", "fr", "b", 4),
             (203, "!!! 123", "en", "b", 7), (None, text(70), "en", "a", 1), (None, None, None, None, None),
             (204, text(9000), "en", "big", 1)]
    rows += [(300, rows[0][1], "en", "a", 1)] * 3 + [rows[5]] * 2 + [(5, text(60), "en", "b", 1)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOC_SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def clash():
    """Extra columns with names that operators also use."""
    def add(df):
        for c in ("size", "shard", "score", "held_out", "idx", "words", "common", "n_lines", "class", "component_id"):
            df = df.withColumn(c, F.lit("x"))
        return df
    return add
