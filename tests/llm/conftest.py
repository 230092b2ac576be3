import random

import pytest

# Names the operators use inside, as further columns of their input.
CLASHES = (
    "score text_ id th spans words bucket slot shard digest node head size n label toxic pos hashes "
    "_id _th _TH_ spans_ _digest _part _rank _start _first _fits h first rest tree region rep least "
    "kept component units stood seen runs collapsed conversation piece position record"
).split()


@pytest.fixture(scope="session")
def odd_texts():
    """(doc_id, text) with nulls, empty, blank, short, long and repeated texts; two rows are equal."""
    source = random.Random(5)
    words = ["alpha", "Beta", "gamma", "élan", "Über", "the", "of", "x1", "##", "a|b"]
    long = " ".join(source.choice(words) + str(source.randrange(900)) for _ in range(30_000))
    plain = " ".join(source.choice(words) for _ in range(40))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "One"),
        (5, "one"),
        (6, plain),
        (7, plain),
        (7, plain),
        (8, plain.replace("the", "THE").replace("of", "Of")),
        (9, long),
        (10, long + " tail"),
        (11, "same line\nsame line\nsame line\n"),
        (12, "aaaa" * 300),
        (None, plain),
        (None, None),
        (13, "é" * 500),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASHES)
    rows = [(i, t, None, None, None if t is None else len(t), *([1] * len(CLASHES))) for i, t in odd_texts]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def make_docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda rows: make_docs(spark, rows)
