import pytest

#: Rows that every operator on texts must take: nulls, no words, a long text, repeated rows and ids, ties.
LONG = "word " * 30_000 + "\n" + "x" * 50_000
ROWS = [
    (1, "The cat sat on the mat. The cat sat on the mat.\nA line\nA line", "a"), (2, None, "a"), (3, "", None), (4, "  \t \n ", "b"), (None, "text without id", "b"), (5, "same", "a"), (5, "same", "a"), (6, LONG, "c"),
    (7, "é\u00a0ß 日本語 😀 \u2028 a\x00b", "c"), (8, "a  b\n c<|endoftext|> $$$ ### 1d10t", None), (9, "same", "b"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """The rows with further columns whose names the operators use inside."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    for name in ("n", "ids", "score", "bucket", "token", "label", "t", "y", "start", "component_id", "kept", "h1", "_text"):
        df = df.selectExpr("*", f"doc_id as `{name}`")
    return df.repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(1, 10)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
