import pytest

ODD_SCHEMA = (
    "doc_id long, text string, key long, label int, batch string, pos int, bucket int, content string, node int, n int, "
    "score double, shard int"
)
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): nulls, empties, copies, ties, repeated rows, a very long text."""
    base = "The quick brown fox jumps over the lazy dog and runs far away into the deep dark forest tonight. "
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, base * 3), (5, (base * 3).upper()), (6, base * 3), (6, base * 3),
        (7, "x"), (8, "One two"), (9, LONG), (10, LONG), (None, base * 3), (None, None), (11, "Übergrößé " * 40),
        (12, "übergrößé " * 40), (13, base * 2 + "Something else entirely follows here, which no other text has at all."),
        (-5, "mail a.b@c.de or +49 171 1234567"), (14, "\\ <s> [INST] %s \u0000  "), (15, base * 3 + "Extra."),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The rows with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 1, 0, "b", 2, 3, "c", 4, 5, 0.5, 6) for i, t in odd_rows], ODD_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
