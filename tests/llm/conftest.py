import pytest

EDGE = [
    (1, "", "x"), (2, None, "y"), (None, "plain words here and there for a while", None), (4, "a", "x"),
    (5, "one two three", "x"), (5, "one two three", "x"), (6, "One TWO three", None),
    (7, " ".join(f"w{i}" for i in range(30_000)), "x"), (8, " ".join(f"w{i}" for i in range(30_000)) + " end", "x"),
    (9, "\t \n", "x"), (10, "naïve ñandú 東京   token: \U0001f600", "x"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE, "doc_id bigint, text string, source string")
    return df.withColumns({c: F.lit("clash") for c in ("key", "id", "row", "n", "cls", "node", "secrets", "host", "window", "part")})


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)
