import random

import pytest

EXTRA = "row int, score double, bucket int, rep string, words string, kept int, label string, lang string, source string"


def extra_columns(df):
    """Columns whose names clash with those the operators use."""
    from pyspark.sql import functions as F

    for column in EXTRA.split(", "):
        name, kind = column.split()
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


@pytest.fixture(scope="session")
def prose():
    """prose(n, seed, …): n words of one of two made-up languages."""
    syllables = {"aa": ["ta", "ko", "mi", "ru", "sen"], "bb": ["zög", "flu", "brä", "nix", "ul"]}

    def make(n, seed, lang="aa"):
        r = random.Random(seed)
        return " ".join("".join(r.choice(syllables[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def edge_documents(spark, prose):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns."""
    long = " ".join(prose(5000, s) for s in range(6))
    rows = [
        (1, prose(40, 1)), (1, prose(40, 1)), (2, prose(40, 1)), (3, None), (4, ""), (5, " \n\t "), (None, prose(30, 2)), (None, None),
        (6, long), (7, "one two"), (8, "one two"), (9, "…!? 123"), (10, "日本語 текст naïve ÉCOLE"), (11, "a" * 3000), (12, "\x00 b\x00c"),
    ]
    return extra_columns(spark.createDataFrame(rows, "doc_id bigint, text string"))


@pytest.fixture(scope="session")
def no_documents(spark):
    return extra_columns(spark.createDataFrame([], "doc_id bigint, text string"))


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
